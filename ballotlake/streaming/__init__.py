"""Ingest as a file stream."""
