"""Structured Streaming: incremental ingest of landed feed documents."""
