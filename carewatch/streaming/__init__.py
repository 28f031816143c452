"""Structured Streaming ingest of landed pages."""

from .ingest import ingest_pages_stream, page_stream  # noqa: F401
