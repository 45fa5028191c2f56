"""Structured Streaming: ingest and incremental refresh."""
