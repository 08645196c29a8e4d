"""Structured Streaming variants of path building and cell aggregation."""

from .paths import stream_cell_counts, stream_segments, stream_segments_ordered, stream_tripline

__all__ = ["stream_cell_counts", "stream_segments", "stream_segments_ordered", "stream_tripline"]
