"""Landed files that may be delivered again: a cursor of drops, and replacement of one drop's rows.

The reference's file sensor fires when the landed CSV has a new modification time, also under the
same name. Here a *drop* is what lies directly in the landing folder: a file, or a folder of files
that one job wrote. The cursor table ``bronze.<name>_drops`` holds a fingerprint of each drop's
files (names, modification times, lengths). A drop whose fingerprint is new or changed is read, and
its rows replace those that the drop had given before: the Bronze table is partitioned by drop, so
the other drops' files are not touched.

The cursor is written after the rows. A run that dies in between is repeated by the next one, which
reads the same drops and replaces the same partitions: the table comes out the same. A drop that
is gone from the landing folder keeps its rows (landing folders are cleaned up). Files that
appear while a run reads are seen by the next run.

The listing is Spark's own; only names of changed drops and of their files reach the driver, which
holds them for any file scan.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.operators.cleaning import stamp
from lakeops.sources.bronze import Lake
from lakeops.sources.files import AD_SPEND_SCHEMA, _missing, read_csv_typed

DROP = "_drop"
CURSOR_SCHEMA = "drop string, fingerprint long, files long, bytes long, modified timestamp"


@dataclass(frozen=True)
class Ingest:
    """What a run took in: names of the drops, and the values of ``touched`` that their old or new rows have."""

    drops: list[str] = field(default_factory=list)
    touched: list = field(default_factory=list)


def listed(lake: Lake, landing: str, pattern: str = "*.csv") -> DataFrame:
    """(path, drop, modified, length) of the landed files; a missing folder raises ``FileNotFoundError``."""
    reader = lake.spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    try:
        files = reader.load(landing)  # its contents are never read: the columns below come from the listing
    except AnalysisException as e:
        if _missing(e):
            raise FileNotFoundError(f"no landing folder at {landing}") from e
        raise
    return files.select("path", _drop_of(F.col("path"), _bare_folder(lake, landing)).alias("drop"), F.col("modificationTime").alias("modified"), "length")


def _drop_of(path, folder: str):
    """First part of a path below the landing folder, whose name comes without scheme and host (`_bare_folder`)."""
    bare = F.regexp_replace(path, "^[A-Za-z0-9+.-]+:/+", "/")
    return F.split_part(F.substring(bare, F.lit(len(folder) + 2), F.length(bare)), F.lit("/"), F.lit(1))


def _bare_folder(lake: Lake, landing: str) -> str:
    path, fs = lake._folder(landing)
    return re.sub(r"^[A-Za-z0-9+.-]+:/+", "/", fs.makeQualified(path).toString()).rstrip("/")


def drops(files: DataFrame) -> DataFrame:
    """One row per drop: its fingerprint and size."""
    one = F.xxhash64("path", "modified", "length")
    return files.groupBy("drop").agg(
        F.bit_xor(one).alias("fingerprint"),
        F.count(F.lit(1)).alias("files"),
        F.sum("length").alias("bytes"),
        F.max("modified").alias("modified"),
    )


def ingest_drops(
    lake: Lake,
    landing: str,
    name: str = "raw_ad_spend",
    schema: T.StructType = AD_SPEND_SCHEMA,
    load_col: str = "_dlt_load_time",
    run_ts: datetime | None = None,
    touched: str | None = None,
) -> Ingest:
    """Take new and changed CSV drops of ``landing`` into ``bronze.<name>``; returns what was taken.

    Rows without ``load_col`` get ``run_ts``. ``touched`` is an SQL expression whose values, in the rows that
    come and in those that go, the caller wants back (regions, to refresh what is built on them; a bounded number).
    """
    cursor = f"{name}_drops"
    now = drops(listed(lake, landing))
    known = lake.attach("bronze", cursor)
    seen = lake.ref("bronze", cursor) if known else lake.spark.createDataFrame([], CURSOR_SCHEMA)
    same = ["drop", "fingerprint"]
    changed = [r["drop"] for r in now.join(seen.select(*same), same, "left_anti").select("drop").collect()]
    if not changed:
        return Ingest()
    files = [r["path"] for r in listed(lake, landing).where(F.col("drop").isin(changed)).select("path").collect()]
    rows = read_csv_typed(lake.spark, files, schema)
    if load_col not in schema.fieldNames():
        if run_ts is None:
            raise ValueError("run_ts is needed to stamp a load time")
        rows = stamp(rows, load_col, run_ts)
    # unlike the listing, the metadata column has paths as URIs
    read_from = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    rows = rows.withColumn(DROP, _drop_of(read_from, _bare_folder(lake, landing)))
    values = set()
    held = lake.attach("bronze", name)
    if held and touched:
        before = lake.ref("bronze", name).where(F.col(DROP).isin(changed))
        values |= {r[0] for r in before.select(F.expr(touched)).distinct().collect()}
    full = lake.replace_partitions(rows, "bronze", name, [DROP])
    after = lake.spark.table(full).where(F.col(DROP).isin(changed))
    if held:  # a drop without rows now has no partition that could replace its old one
        full_now = {r[0] for r in rows.select(DROP).distinct().collect()}
        lake.drop_partitions("bronze", name, DROP, sorted(set(changed) - full_now))
    if touched:
        values |= {r[0] for r in after.select(F.expr(touched)).distinct().collect()}
    read = now.where(F.col("drop").isin(changed))
    lake.write(seen.where(~F.col("drop").isin(changed)).unionByName(read), "bronze", cursor)
    return Ingest(sorted(changed), sorted(values, key=lambda v: (v is not None, v)))
