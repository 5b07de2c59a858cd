"""Structured Streaming form of the incremental ingest."""

from matchlake.streaming.ingest_stream import start_ingest_stream  # noqa: F401
