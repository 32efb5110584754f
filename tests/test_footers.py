"""Row counts and latest values from Parquet footers: what a scan gives, without reading rows."""

from datetime import datetime, timedelta

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from lakeops.operators import checks as C
from lakeops.plans import quality
from lakeops.session import shared_path
from lakeops.sources import footers
from lakeops.sources.bronze import Lake
from lakeops.sources.footers import footer_stats

NOW = datetime(2024, 2, 10)
COLUMNS = ("id", "day", "ntz", "tz", "none")


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(1000, numPartitions=4).selectExpr(
        "id",
        "DATE'2024-01-01' + CAST(id % 31 AS INT) AS day",
        "CASE WHEN id % 5 > 0 THEN TIMESTAMP_NTZ'1969-12-31 23:59:59' + make_dt_interval(0, 0, 0, id / 7) END AS ntz",
        "CAST(TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id * 0.000001) AS TIMESTAMP) AS tz",
        "CAST(NULL AS TIMESTAMP_NTZ) AS none",
        "concat('p 1:%', id % 3) AS part",
        "CAST(id AS STRING) AS text",
    )


def scanned(df, columns):
    return df.agg(F.count(F.lit(1)), *(F.max(c) for c in columns)).first()


@pytest.mark.parametrize("parts", [(), ("part",)])
@pytest.mark.parametrize("kind", ["INT96", "TIMESTAMP_MICROS"])
def test_footers_say_what_a_scan_says(spark, rows, parts, kind):
    lake = Lake(spark, shared_path(spark, "footers", unique=True))
    spark.conf.set("spark.sql.parquet.outputTimestampType", kind)  # INT96 has no statistics: the column is read
    try:
        name = lake.write(rows, "bronze", "t", partition_by=parts)
    finally:
        spark.conf.unset("spark.sql.parquet.outputTimestampType")
    got = lake.stats("bronze", "t", COLUMNS)
    assert tuple(got.first()) == tuple(scanned(spark.table(name), COLUMNS))
    assert got.columns == ["row_count", *COLUMNS]
    for c in COLUMNS:
        assert got.schema[c].dataType == rows.schema[c].dataType


def test_no_row_group_is_read_where_statistics_are_held(tmp_path, monkeypatch):
    t = pa.table({"ts": pa.array([datetime(2024, 1, i + 1) for i in range(9)], pa.timestamp("us")), "n": list(range(9))})
    pq.write_table(t, tmp_path / "a.parquet", row_group_size=4)
    monkeypatch.setattr(footers, "_read_latest", lambda *_: pytest.fail("a column was read"))
    count, (latest, n, missing) = footers.latest_of(str(tmp_path / "a.parquet"), ["ts", "n", "later column"])
    assert (count, n, missing) == (9, 8, None)
    assert latest == (datetime(2024, 1, 9) - datetime(1970, 1, 1)) // timedelta(microseconds=1)


def test_a_row_group_without_statistics_is_read(tmp_path):
    t = pa.table({"ts": pa.array([datetime(2024, 1, 5), None, datetime(2023, 1, 1)], pa.timestamp("us"))})
    pq.write_table(t, tmp_path / "a.parquet", write_statistics=False)
    assert footers.latest_of(str(tmp_path / "a.parquet"), ["ts"]) == (3, [1704412800000000])


def test_empty_missing_and_refused(spark, rows):
    lake = Lake(spark, shared_path(spark, "footers", unique=True))
    for parts in ((), ("part",)):
        lake.write(rows.where("false"), "bronze", f"empty{len(parts)}", partition_by=parts)
        assert tuple(lake.stats("bronze", f"empty{len(parts)}", ["ntz"]).first()) == (0, None)
    with pytest.raises(FileNotFoundError):
        lake.stats("bronze", "nothing")
    with pytest.raises(FileNotFoundError):
        footer_stats(spark, shared_path(spark, "no-such-folder"), rows.schema)
    lake.write(rows, "bronze", "t")
    with pytest.raises(ValueError, match="text"):
        lake.stats("bronze", "t", ["text"])


def test_checks_from_footers_equal_those_on_rows(spark, rows):
    lake = Lake(spark, shared_path(spark, "footers", unique=True))
    name = lake.write(rows, "bronze", "t")
    hour = timedelta(hours=1)
    checks = [C.freshness("tz", w * hour, e * hour, NOW) for w, e in ((1, 2), (900, 2000), (1000, 2000), (2000, 3000))]
    checks += [C.freshness("none", hour, hour, NOW), C.staleness("day", 24 * hour, NOW), C.staleness("day", 400 * hour, NOW)]
    checks += [C.row_count_between(1, 999), C.row_count_between(1000, None), C.row_count_min(1001), C.row_count_near(1100, 0.1)]
    expected = sorted(map(str, C.run_checks(spark.table(name), "t", checks).collect()))
    assert sorted(map(str, quality.from_footers(lake, {"bronze.t": checks}).collect())) == expected
    with pytest.raises(ValueError, match="not_null"):
        quality.from_footers(lake, {"bronze.t": [C.not_null("id")]})
