"""Streaming entry points: the change merge over a stream of change files."""

from .changes import merge_batch, merge_stream

__all__ = ["merge_batch", "merge_stream"]
