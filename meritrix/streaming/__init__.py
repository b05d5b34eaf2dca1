"""Incremental ingest and refresh."""
