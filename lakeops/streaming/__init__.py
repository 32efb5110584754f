"""Structured Streaming ingest."""

from lakeops.streaming.ingest import ingest_new_csv, land_csv

__all__ = ["ingest_new_csv", "land_csv"]
