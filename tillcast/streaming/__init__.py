"""Structured Streaming ingest (file arrival -> foreachBatch)."""
