"""Structured Streaming form of the incremental load (JOB-1)."""

from lakesync.streaming.incremental import stream_incremental_load

__all__ = ["stream_incremental_load"]
