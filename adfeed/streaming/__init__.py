"""Structured Streaming forms of ingest, deduplication and upsert."""
