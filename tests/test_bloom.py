"""Bloom filters: a lookup by a column that does not order the table reads only the row groups that may hold the value."""

import pytest
from pyspark.sql import functions as F

from lakeops.session import shared_path
from lakeops.sources.bronze import Lake


def rows_read(df):
    """The rows and the scan's own count of rows that it gave on."""
    found = df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.finalPhysicalPlan() if hasattr(plan, "finalPhysicalPlan") and "Adaptive" in plan.nodeName() else plan
    leaves = plan.collectLeaves()
    return found, sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_a_lookup_reads_the_row_groups_that_may_hold_the_value(spark):
    lake = Lake(spark, shared_path(spark, "bloom", unique=True))
    facts = spark.range(40_000).selectExpr("id * 2 AS id", "md5(CAST(id AS STRING)) AS k", "id % 97 AS v")
    facts = facts.repartition(8, "v")  # each file holds ids and keys from the whole range
    plain, filtered = lake.write(facts, "gold", "plain"), lake.write(facts, "gold", "filtered", bloom=("id", "k"))
    files = spark.table(filtered).select("_metadata.file_path").distinct().count()
    assert files > 4
    largest = spark.table(filtered).groupBy(F.col("_metadata.file_path")).count().agg(F.max("count")).first()[0]
    for lookup in (F.col("id") == 31_000, F.col("k") == "no key", F.col("id") == 31_001, F.col("id").isin(40_002, 40_004)):
        expected, all_read = rows_read(spark.table(plain).where(lookup))
        got, read = rows_read(spark.table(filtered).where(lookup))
        assert sorted(map(str, got)) == sorted(map(str, expected))
        assert read <= largest * len(got) < all_read or not got, (str(lookup), read, largest, len(got), all_read)
    found, read = rows_read(spark.table(filtered).where("id = 31001"))
    assert not found and read == 0  # within the range of every file, in none of them


def test_partitions_appends_and_refused_columns(spark):
    lake = Lake(spark, shared_path(spark, "bloom", unique=True))
    facts = spark.range(1000).selectExpr("id", "CAST(id % 3 AS STRING) AS part")
    name = lake.write(facts, "gold", "t", partition_by=("part",), bloom=("id",))
    lake.write(facts, "gold", "t", mode="append", partition_by=("part",), bloom=("id",))
    assert spark.table(name).where("id = 17").count() == 2
    for column in ("part", "nothing"):
        with pytest.raises(ValueError, match=column):
            lake.write(facts, "gold", "t", partition_by=("part",), bloom=(column,))
