"""Incremental variants on Structured Streaming file sources."""
