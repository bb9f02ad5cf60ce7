"""Incremental file loading with Structured Streaming."""
