"""Row counts and latest values of Parquet tables, from the footers of their files.

Spark answers counts and the extremes of numbers and dates from footers, but not of instants, which freshness asks
for. Here each task opens the footers of the files in its split and adds up what their row groups state. The data of
a column are read only in a row group that has no statistics for it (Spark's INT96 timestamps have none).
Statistics of the types allowed here are exact: Parquet shortens only those of strings and decimals.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from datetime import date, datetime, timedelta, timezone

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as fs
import pyarrow.parquet as pq
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.functions.keys import quote
from lakeops.sources.files import _missing

ROWS = "row_count"
_EPOCH, _DAY_0 = datetime(1970, 1, 1), date(1970, 1, 1)
_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_TYPES = (*_INTEGERS, T.DateType, T.TimestampType, T.TimestampNTZType)


def _open(uri: str) -> pa.NativeFile:
    """A file by the name that Spark lists, in which no character is escaped."""
    scheme, authority, place = re.fullmatch(r"(?:([a-zA-Z][a-zA-Z0-9+.-]*):(?://([^/]*))?)?(/.*)", uri).groups()
    if scheme in (None, "file"):
        return fs.LocalFileSystem().open_input_file(place)
    system, root = fs.FileSystem.from_uri(f"{scheme}://{authority or ''}/")
    return system.open_input_file(root.rstrip("/") + place)


def _number(value) -> int | None:
    """Instants in microseconds, dates in days, integers as they are; None for what is none of these."""
    if isinstance(value, datetime):
        utc = value.astimezone(timezone.utc).replace(tzinfo=None) if value.tzinfo else value
        return (utc - _EPOCH) // timedelta(microseconds=1)
    if isinstance(value, date):
        return (value - _DAY_0).days
    return value if isinstance(value, int) else None


def _read_latest(file: pq.ParquetFile, group: int, column: str) -> int | None:
    values = file.read_row_group(group, columns=[column]).column(column)
    if pa.types.is_timestamp(values.type):
        values = values.cast(pa.timestamp("us", values.type.tz), safe=False)
    return _number(pc.max(values).as_py())


def latest_of(uri: str, columns: Sequence[str]) -> tuple[int, list[int | None]]:
    """Rows of a file, and for each column the latest value as a number, None if the file has no value of it."""
    with _open(uri) as source:
        file = pq.ParquetFile(source)
        held = file.metadata
        places = {held.schema.column(i).path: i for i in range(held.num_columns)}
        latest: list[int | None] = [None] * len(columns)
        for group in range(held.num_row_groups):
            meta = held.row_group(group)
            for c, name in enumerate(columns):
                if name not in places or not meta.num_rows:
                    continue
                stats = meta.column(places[name]).statistics
                if stats is not None and stats.has_null_count and stats.null_count == meta.num_rows:
                    continue
                value = _number(stats.max) if stats is not None and stats.has_min_max else None
                value = _read_latest(file, group, name) if value is None else value
                if value is not None:
                    latest[c] = value if latest[c] is None else max(latest[c], value)
        return held.num_rows, latest


def footer_stats(spark: SparkSession, path: str, schema: T.StructType, latest: Sequence[str] = ()) -> DataFrame:
    """One row: ``row_count``, and for each column in ``latest`` its greatest value under the column's name.

    ``path`` is a Parquet file, folder or glob, ``schema`` that of its rows. The columns may be integers, dates or
    instants and must be stored in the files: a partition column is none of theirs. NULLs are no values; a column without any is
    NULL, and so is one that no file has. An empty table has ``row_count`` 0. A missing ``path`` raises
    ``FileNotFoundError``.
    """
    for name in latest:
        if not isinstance(schema[name].dataType, _TYPES):
            raise ValueError(f"no latest value of {name}: {schema[name].dataType.simpleString()}")
    names = [f"n{i}" for i in range(len(latest))]
    sent = pa.schema([(ROWS, pa.int64()), *((n, pa.int64()) for n in names)])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [latest_of(uri, latest) for uri in batch.column(0).to_pylist()]
            columns = [pa.array([n for n, _ in found], pa.int64())]
            columns += [pa.array([values[i] for _, values in found], pa.int64()) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays(columns, schema=sent)

    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path")
    except AnalysisException as e:
        if _missing(e):
            raise FileNotFoundError(f"Parquet input not found at {path}") from e
        raise
    each = files.mapInArrow(scan, ", ".join(f"{n} long" for n in sent.names))
    total = each.agg(F.coalesce(F.sum(ROWS), F.lit(0)).alias(ROWS), *(F.max(n).alias(n) for n in names))

    def typed(number: str, name: str) -> str:
        kind = schema[name].dataType
        value = {T.DateType: f"date_from_unix_date(CAST({number} AS INT))", T.TimestampType: f"timestamp_micros({number})"}
        value[T.TimestampNTZType] = f"CAST(timestamp_micros({number}) AS TIMESTAMP_NTZ)"
        return f"{value.get(type(kind), f'CAST({number} AS {kind.simpleString()})')} AS {quote(name)}"

    return total.selectExpr(ROWS, *(typed(n, name) for n, name in zip(names, latest)))
