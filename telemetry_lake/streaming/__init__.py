"""Incremental runs as Structured Streaming queries that stop when they have caught up."""
