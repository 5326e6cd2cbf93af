"""Scans, sinks, views over the given tables and generated data."""
