"""The ingest as an incremental job, and weekly counts over arriving files."""

from mailweave.streaming.ingest import parse_new_files
from mailweave.streaming.weekly import closed_weeks, count_new_files, late_copies, weekly_edges

__all__ = ["closed_weeks", "count_new_files", "late_copies", "parse_new_files", "weekly_edges"]
