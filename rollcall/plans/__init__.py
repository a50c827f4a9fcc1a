"""Whole jobs, and the queries that run them on the benchmark tables."""
