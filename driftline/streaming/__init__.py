"""Continuous form of the delta strategies."""

from driftline.streaming.deltas import drain, stream_deltas

__all__ = ["drain", "stream_deltas"]
