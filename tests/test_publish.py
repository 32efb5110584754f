"""Replacing published tables: readers always find them, schemas are kept, single partitions are replaced."""

import threading

import pytest
from pyspark.sql import functions as F

from lakeops.session import shared_path
from lakeops.sources.bronze import Lake


@pytest.fixture
def lake(spark):
    return Lake(spark, shared_path(spark, "publish", unique=True))


def files(spark, df):
    return {r[0] for r in df.select("_metadata.file_name").distinct().collect()}


@pytest.mark.parametrize("parts", [(), ("day",)])
def test_a_reader_in_a_loop_never_misses_the_table(spark, lake, parts):
    def version(n):
        return spark.range(n).selectExpr("id", "CAST(id % 3 AS STRING) AS day")

    name = lake.write(version(10), "gold", "numbers", partition_by=parts)
    seen, failed, stop = [], [], threading.Event()

    def read():
        while not stop.is_set():
            try:
                seen.append(spark.table(name).count())
            except Exception as e:  # noqa: BLE001 - whatever a reader meets is a failure here
                failed.append(e)

    reader = threading.Thread(target=read)
    reader.start()
    for n in range(11, 21):
        assert lake.write(version(n), "gold", "numbers", partition_by=parts) == name
    stop.set()
    reader.join()
    assert not failed and seen and set(seen) <= set(range(10, 21)) and seen == sorted(seen)
    assert spark.table(name).count() == 20


def test_a_crash_between_the_steps_leaves_the_old_version(spark, lake, monkeypatch):
    name = lake.write(spark.range(5), "gold", "numbers")

    def crash(*_):
        raise RuntimeError("crash")

    for step in ("_describe", "_point"):
        with monkeypatch.context() as m:
            m.setattr(Lake, step, crash)
            with pytest.raises(RuntimeError, match="crash"):
                lake.write(spark.range(9), "gold", "numbers")
        assert spark.table(name).count() == 5
    with monkeypatch.context() as m:  # location changed, columns not yet
        m.setattr(Lake, "_set_columns", crash)
        with pytest.raises(RuntimeError, match="crash"):
            lake.write(spark.range(9).withColumn("more", F.lit("x")), "gold", "numbers")
    assert spark.table(name).count() == 9
    lake.write(spark.range(9).withColumn("more", F.lit("x")), "gold", "numbers")
    assert spark.table(name).columns == ["id", "more"] and spark.table(name).where("more = 'x'").count() == 9


def test_other_columns_and_types(spark, lake):
    name = lake.write(spark.range(5), "gold", "t")
    lake.write(spark.range(3).selectExpr("CAST(id AS STRING) AS id", "1.5D AS x"), "gold", "t")
    assert dict(spark.table(name).dtypes) == {"id": "string", "x": "double"} and spark.table(name).count() == 3
    lake.write(spark.range(4).selectExpr("id", "id % 2 AS p"), "gold", "t", partition_by=("p",))
    assert spark.table(name).where("p = 1").count() == 2


def test_partition_types_without_a_catalog_entry(spark, lake):
    df = spark.sql("SELECT 1 AS id, '2024-01-05' AS date UNION ALL SELECT 2, NULL UNION ALL SELECT 3, '007'")
    name = lake.write(df, "bronze", "raw", partition_by=("date",))
    spark.sql(f"DROP TABLE {name}")  # as in a new session
    again = lake.ref("bronze", "raw")
    assert dict(again.dtypes)["date"] == "string"
    assert sorted(map(tuple, again.select("id", "date").collect())) == [(1, "2024-01-05"), (2, None), (3, "007")]
    lake.write(spark.sql("SELECT 4 AS id, '007' AS date"), "bronze", "raw", mode="append", partition_by=("date",))
    assert spark.table(name).count() == 4  # appended to the version, which is not replaced


def test_partitions_are_replaced_alone(spark, lake):
    def rows(days, add):
        return spark.range(40).selectExpr(f"id + {add} AS id", "concat('d', id % 4) AS day").where(F.col("day").isin(days))

    name = lake.replace_partitions(rows(["d0", "d1", "d2"], 0), "silver", "t", ("day",))
    before = files(spark, spark.table(name).where("day = 'd1'"))
    lake.replace_partitions(rows(["d0", "d3"], 100), "silver", "t", ("day",))
    assert files(spark, spark.table(name).where("day = 'd1'")) == before
    got = {r["day"]: (r["n"], r["low"]) for r in spark.table(name).groupBy("day").agg(F.count("*").alias("n"), F.min("id").alias("low")).collect()}
    assert got == {"d0": (10, 100), "d1": (10, 1), "d2": (10, 2), "d3": (10, 103)}
    lake.drop_partitions("silver", "t", "day", ["d2", "none"])
    assert spark.table(name).count() == 30
    with pytest.raises(ValueError, match="not partitioned by"):
        lake.replace_partitions(rows(["d0"], 0), "silver", "t", ("id",))


def test_tables_are_written_with_zstd(spark, tmpdir_path):
    """Keys are hexadecimal digits, of which snappy saves nothing."""
    import glob

    import pyarrow.parquet as pq

    lake = Lake(spark, tmpdir_path, namespace="zstd")
    keys = spark.range(5000).selectExpr("id", "id % 2 AS part", "md5(CAST(id AS STRING)) AS key")
    lake.write(keys, "silver", "whole")
    lake.write(keys, "silver", "parts", partition_by=("part",))
    lake.replace_partitions(keys.where("part = 1"), "silver", "parts", ("part",))
    files = glob.glob(f"{tmpdir_path}/silver/**/*.parquet", recursive=True)
    metas = [pq.ParquetFile(f).metadata for f in files]
    chunks = [m.row_group(g).column(c) for m in metas for g in range(m.num_row_groups) for c in range(m.num_columns)]
    assert chunks and {c.compression for c in chunks} == {"ZSTD"}
    assert lake.ref("silver", "parts").count() == lake.ref("silver", "whole").count() == 5000
