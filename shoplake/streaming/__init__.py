"""Continuous ingestion and incremental maintenance of the cleansed tables."""

from shoplake.streaming.files import listed_table, load_files, merge_listed
from shoplake.streaming.ingest import FEEDS, ingest_stream
from shoplake.streaming.merge import backfill, merge_stream, read_merged

__all__ = [
    "FEEDS",
    "backfill",
    "ingest_stream",
    "listed_table",
    "load_files",
    "merge_listed",
    "merge_stream",
    "read_merged",
]
