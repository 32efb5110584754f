"""The five raw tables from their real sources (A7): database, JSON file, CSV file."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from lakeops.operators.cleaning import stamp
from lakeops.sources.files import read_csv_typed, read_json_array
from lakeops.sources.jdbc import key_range, read_jdbc

DATABASE_TABLES = {"raw_clients": "clients", "raw_leads": "leads", "raw_appointments": "appointments"}


def raw_from_sources(
    spark: SparkSession,
    run_ts: datetime,
    jdbc_url: str | None = None,
    jdbc_properties: Mapping[str, str] | None = None,
    jdbc_parts: int = 1,
    key_bounds: Mapping[str, tuple[int, int]] | None = None,
    seo_json: str | None = None,
    seo_json_lines: bool = False,
    ad_spend_csv: str | None = None,
) -> dict[str, DataFrame]:
    """Raw tables for every source given; the file sources get a ``_dlt_load_time`` stamp.

    Database tables are read whole (they carry their own ``_loaded_at``); with
    ``jdbc_parts > 1`` the read is split into parallel ranges of ``id``, between
    the table's ``key_bounds`` or, where none are given, what the database says.
    ``seo_json_lines`` reads the SEO file as JSON Lines, which splits into many tasks.
    """
    out: dict[str, DataFrame] = {}
    if jdbc_url:
        for raw, table in DATABASE_TABLES.items():
            bounds = (key_bounds or {}).get(raw)
            if jdbc_parts > 1 and bounds is None:
                bounds = key_range(spark, jdbc_url, table, "id", jdbc_properties)
            out[raw] = read_jdbc(spark, jdbc_url, table, key="id" if bounds else None, bounds=bounds,
                                 parts=jdbc_parts, properties=jdbc_properties)
    if seo_json:
        out["raw_seo_rankings"] = stamp(read_json_array(spark, seo_json, json_lines=seo_json_lines), "_dlt_load_time", run_ts)
    if ad_spend_csv:
        out["raw_ad_spend"] = stamp(read_csv_typed(spark, ad_spend_csv), "_dlt_load_time", run_ts)
    return out
