"""Structured Streaming form of the raw load (incremental ingest of new export files)."""

from cauce.streaming.ingest import line_stream, read_streamed_raw, stream_raw

__all__ = ["line_stream", "read_streamed_raw", "stream_raw"]
