"""Readers, writers and table storage."""
