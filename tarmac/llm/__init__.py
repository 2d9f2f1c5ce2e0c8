"""Operators of a training-data pipeline: search, joins, scans, mixing and binary output."""
