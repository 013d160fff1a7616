"""Structured Streaming ingest; see ``tidemark.streaming.ingest``."""
