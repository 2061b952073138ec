"""Structured Streaming forms of feed ingestion, deduplication and upsert."""
