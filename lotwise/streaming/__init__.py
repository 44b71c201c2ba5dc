"""Incremental ingest and enrichment with Structured Streaming."""
