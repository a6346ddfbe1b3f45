"""Batch-bounded ingest expressed with Structured Streaming."""
