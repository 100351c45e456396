"""Incremental loading of new day files with Structured Streaming."""
