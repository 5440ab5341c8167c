"""Incremental refresh on Structured Streaming."""
