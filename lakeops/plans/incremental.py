"""Silver kept up to date by regions: only what newly landed rows can change is built again.

A *region* is a value of an expression of a model's dedup key: a date that is part of the key, or a
hash bucket of the key. All rows of a key lie in one region, so the latest rows of a region
depend on the region's raw rows only. Bronze and Silver tables are partitioned by region; newly landed rows are
added to Bronze, and the model runs on the Bronze rows of the regions that occur in them. The rows replace those
partitions of Silver. The model, and with it the total order of its dedup, is the one of the full
build, so the result equals a full build over all raw rows; files of other regions stay as they are.

Work and shuffle follow the regions touched, not the table. Re-running a refresh gives the same table.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.plans import silver
from lakeops.sources.bronze import Lake
from lakeops.sources.files import AD_SPEND_SCHEMA
from lakeops.sources.landing import Ingest, ingest_drops

REGION = "_region"
AD_DAY = ("CAST(date AS DATE)", "spend_date")  # the day of a raw ad spend row, and of a Silver one


def by_bucket(*keys: str, buckets: int = 64) -> Column:
    """Region of a key without a date: one of ``buckets`` hash buckets. Their number must not change later."""
    return F.concat(F.lit("b"), F.lpad(F.pmod(F.xxhash64(*map(F.expr, keys)), F.lit(buckets)).cast("string"), 6, "0"))


def by_date(day: str) -> Column:
    """Region of a key with a date; ``day`` is an expression of type date."""
    return F.coalesce(F.expr(day).cast("string"), F.lit("none"))


def land(lake: Lake, rows: DataFrame, name: str, region: Column) -> list[str]:
    """Append rows to ``bronze.<name>``, partitioned by region; returns the regions that occur in them."""
    marked = rows.withColumn(REGION, region)
    lake.write(marked, "bronze", name, mode="append", partition_by=(REGION,))
    return [r[0] for r in marked.select(REGION).distinct().collect()]


def refresh(
    lake: Lake,
    raw: DataFrame,
    name: str,
    model: Callable[[DataFrame], DataFrame],
    regions: Sequence[str],
    region: Column,
    raw_region: Column | None = None,
) -> str:
    """Build ``silver.<name>`` again for the regions, from all of ``raw``'s rows in them.

    ``region`` tells the region of a row of the model, ``raw_region`` that of a raw row; without it ``raw`` has the
    column `REGION`, and where it is partitioned by it only those partitions are read. The two must agree:
    take both from the typed key. A region without raw rows is dropped. Regions are a bounded number
    of names: dates or buckets.
    """
    marked = raw if raw_region is None else raw.withColumn(REGION, raw_region)
    wanted = sorted(regions)
    some = marked.where(F.col(REGION).isin(wanted))
    rows = model(some.drop(REGION)).withColumn(REGION, region)
    there = lake.attach("silver", name)
    full = lake.replace_partitions(rows, "silver", name, [REGION])
    if there:
        left = {r[0] for r in some.select(REGION).distinct().collect()}
        lake.drop_partitions("silver", name, REGION, sorted(set(wanted) - left))
    return full


def ingest_ad_spend(lake: Lake, landing: str, run_ts: datetime, schema: T.StructType = AD_SPEND_SCHEMA) -> Ingest:
    """Take new and re-delivered drops of ad spend into Bronze and refresh Silver for the days of their old and new rows.

    If a run ends before Silver is refreshed, pass the days to `refresh` again or rebuild the model: the
    cursor already counts the drops as taken.
    """
    raw_day, day = map(by_date, AD_DAY)
    got = ingest_drops(lake, landing, schema=schema, run_ts=run_ts, touched=f"coalesce(CAST({AD_DAY[0]} AS STRING), 'none')")
    if got.touched:
        model = partial(silver.stg_ad_spend, run_ts=run_ts)
        refresh(lake, lake.ref("bronze", "raw_ad_spend"), "stg_ad_spend", model, got.touched, day, raw_day)
    return got
