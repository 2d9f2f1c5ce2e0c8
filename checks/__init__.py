"""Queries over the test tables and the SQL each one is compared with."""
