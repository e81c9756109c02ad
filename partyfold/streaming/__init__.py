"""Structured Streaming entry points (incremental feed landing)."""
