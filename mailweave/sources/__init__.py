"""Readers and writers of the stage tables."""

from mailweave.sources.split_csv import read_large_dump
from mailweave.sources.tables import (
    bucket_count,
    count_short_lines,
    edges_table,
    read_edges,
    read_features,
    read_messages,
    read_messages_json,
    read_ranking,
    write_edges,
    write_features,
    write_messages,
    write_messages_json,
    write_persons,
    write_result,
)

__all__ = [
    "bucket_count",
    "count_short_lines",
    "edges_table",
    "read_edges",
    "read_features",
    "read_large_dump",
    "read_messages",
    "read_messages_json",
    "read_ranking",
    "write_edges",
    "write_features",
    "write_messages",
    "write_messages_json",
    "write_persons",
    "write_result",
]
