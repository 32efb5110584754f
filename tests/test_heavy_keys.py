"""Heavy join keys, joined apart: the same rows, no task with far more of them than the others."""

import statistics
from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lakeops.operators.joins import enrich, exists_flag, heavy_keys, left_join_apart
from lakeops.plans import gold

N = 30_000


@pytest.fixture(scope="module")
def fact(spark):
    key = "CASE WHEN id % 3 = 0 THEN 0 WHEN id % 7 = 0 THEN NULL WHEN id % 5 = 0 THEN 1 ELSE id END AS k"
    return spark.range(N, numPartitions=16).selectExpr("id", key, "CAST(id % 3 AS STRING) AS s")


@pytest.fixture(scope="module")
def dim(spark):
    return spark.range(0, N, 2).selectExpr("id AS k", "concat('d', id) AS d", "id AS other")


@pytest.fixture
def no_broadcast(spark):
    held = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    held["spark.sql.shuffle.partitions"] = "16"
    before = {k: spark.conf.get(k) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def test_heavy_keys_are_found(spark, fact):
    found = heavy_keys(fact, ["k", "s"], 0.05)
    assert sorted(found["k"]) == [0, 1] and sorted(found["s"]) == ["0", "1", "2"]
    assert heavy_keys(fact.where("false"), ["k"]) == {"k": []}
    assert heavy_keys(fact.selectExpr("CAST(NULL AS INT) AS k"), ["k"]) == {"k": []}
    for share in (0, 1e-9, 2):
        with pytest.raises(ValueError):
            heavy_keys(fact, ["k"], share)


@pytest.mark.parametrize("heavy", [[0, 1], [0], [2, 5, 7], [-1], list(range(0, 500))])
def test_joined_apart_gives_the_same_rows(fact, dim, heavy):
    expected = enrich(fact, dim, "k", ["d"])
    got = enrich(fact, dim, "k", ["d"], heavy)
    assert got.columns == expected.columns and got.dtypes == expected.dtypes
    assert bag(got) == bag(expected)
    assert bag(exists_flag(fact, dim, "k", "hit", heavy=heavy)) == bag(exists_flag(fact, dim, "k", "hit"))
    assert bag(exists_flag(fact, fact, "id", "hit", "k", heavy)) == bag(exists_flag(fact, fact, "id", "hit", "k"))


def test_empty_sides_and_odd_names(spark, fact, dim):
    assert left_join_apart(fact.where("false"), dim, "k", [0]).count() == 0
    got = left_join_apart(fact, dim.where("false"), "k", [0])
    assert got.count() == N and got.where("d IS NOT NULL").count() == 0
    odd = left_join_apart(fact.withColumnRenamed("k", "a.b"), dim.withColumnRenamed("k", "a.b"), "a.b", [0])
    assert odd.columns[0] == "a.b" and odd.count() == N


def test_no_task_holds_twice_the_median(no_broadcast, fact, dim):
    def per_task(df):
        return [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]

    plain = per_task(enrich(fact, dim, "k", ["d"]))
    assert max(plain) > 4 * statistics.median(plain)  # key 0 and the rows without a key
    heavy = heavy_keys(fact, ["k"], 0.01)["k"]
    apart = enrich(fact, dim, "k", ["d"], heavy)
    counts = per_task(apart)
    assert sum(counts) == N and max(counts) <= 2 * statistics.median(counts)
    plan = apart._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 1 and plan.count("SortMergeJoin") == 1


def test_marts_are_the_same_with_heavy_keys(spark):
    ts = "TIMESTAMP_NTZ'2024-01-01 00:00:00'"
    appts = spark.range(3000).selectExpr(
        "md5(CAST(id AS STRING)) AS appointment_key", "CAST(id AS INT) AS appointment_id",
        "CAST(CASE WHEN id % 3 = 0 THEN 4 WHEN id % 11 = 0 THEN NULL ELSE id END AS INT) AS lead_id",
        "CAST(CASE WHEN id % 2 = 0 THEN 1 ELSE id % 40 END AS INT) AS client_id", f"{ts} AS scheduled_at",
        "IF(id % 2 = 0, 'completed', 'cancelled') AS appointment_status", f"{ts} AS _loaded_at",
    )
    leads = spark.range(2000).selectExpr(
        "md5(CAST(id AS STRING)) AS lead_key", "CAST(id AS INT) AS lead_id", "CAST(id % 5 AS INT) AS client_id",
        "'paid' AS lead_source", "'new' AS lead_status", "CAST(id AS DECIMAL(10,2)) AS lead_value",
        f"{ts} AS created_at", f"{ts} AS _loaded_at",
    )
    clients = spark.range(30).selectExpr("CAST(id AS INT) AS client_id", "'legal' AS industry", "concat('p', id) AS plan_tier")
    heavy = heavy_keys(appts, ["lead_id", "client_id"], 0.05)
    assert heavy == {"lead_id": [4], "client_id": [1]}
    assert bag(gold.fct_appointments(appts, leads, clients, heavy)) == bag(gold.fct_appointments(appts, leads, clients))
    now = datetime(2024, 2, 10)
    lead_heavy = heavy_keys(leads, ["client_id"], 0.1)
    assert len(lead_heavy["client_id"]) == 5
    assert bag(gold.fct_leads(leads, clients, appts, now, lead_heavy)) == bag(gold.fct_leads(leads, clients, appts, now))
