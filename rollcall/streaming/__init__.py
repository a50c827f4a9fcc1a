"""Continuous ingest of logs."""
