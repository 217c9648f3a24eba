"""Structured Streaming queries: ingest into the lake, streaming metrics, sessions."""
