"""Structured Streaming ingest and cleaning."""
