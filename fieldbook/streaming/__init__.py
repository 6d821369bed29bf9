"""Incremental loads as Structured Streaming jobs (file source -> upserted tables)."""
