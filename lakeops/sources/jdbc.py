"""Database snapshot scans over JDBC, split into parallel key ranges."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


FETCH_SIZE = "10000"


def key_range(
    spark: SparkSession, url: str, table: str, key: str, properties: Mapping[str, str] | None = None
) -> tuple[int, int]:
    """Smallest and largest ``key`` of ``table``, from one query that the database answers itself."""
    query = f"(SELECT min({key}) AS lo, max({key}) AS hi FROM {table}) b"
    row = read_jdbc(spark, url, query, properties=properties).first()
    return (int(row["lo"] or 0), int(row["hi"] or 0))


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    key: str | None = None,
    bounds: tuple[int, int] | None = None,
    parts: int = 1,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """Full-table snapshot of ``table``.

    With ``key`` and ``bounds`` the scan runs as ``parts`` range queries in
    parallel (``key`` should be the primary key); filters and selected columns
    of later operators are pushed into each query. Row order is not kept:
    a table has none.
    """
    if parts > 1 and (key is None or bounds is None):
        raise ValueError("a scan in several parts needs a key column and its bounds")
    opts = {"fetchsize": FETCH_SIZE, **(properties or {})}
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in opts.items():
        reader = reader.option(k, v)
    if parts > 1:
        reader = (
            reader.option("partitionColumn", key)
            .option("lowerBound", str(bounds[0]))
            .option("upperBound", str(bounds[1]))
            .option("numPartitions", str(parts))
        )
    return reader.load()
