"""Incremental arrival through Structured Streaming and written tables."""
