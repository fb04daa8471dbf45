"""Structured Streaming entry points (incremental publishing of landed raw files)."""
