"""Structured Streaming jobs."""

from meterlake.streaming.copy import stream_copy, stream_into_sync

__all__ = ["stream_copy", "stream_into_sync"]
