"""End-to-end runs that wire sources, operators and sinks together."""
