"""Incremental loads as Structured Streaming jobs (file source, availableNow)."""

from tillroll.streaming.incremental import feed_stream, ingest_stream

__all__ = ["feed_stream", "ingest_stream"]
