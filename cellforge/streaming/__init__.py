"""Streaming loads: the line loaders on a text stream, into an append-only cell log."""

from cellforge.streaming.cell_log import (
    compact_cell_log,
    read_cell_log,
    read_line_stream,
    start_cell_log,
    start_reject_counts,
)

__all__ = ["compact_cell_log", "read_cell_log", "read_line_stream", "start_cell_log", "start_reject_counts"]
