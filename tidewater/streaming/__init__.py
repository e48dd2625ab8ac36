"""Incremental landing ingestion driven by Structured Streaming."""
