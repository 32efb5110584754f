"""A third of all rows on one key: results stay whole and exact.

Each operator runs on 16 partitions where key 0 holds a third of the rows; the
answer is compared with a brute-force computation in Python.
"""

from collections import Counter, defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from lakeops.operators import checks as C
from lakeops.operators.aggregates import counts_by
from lakeops.operators.dedup import latest_by
from lakeops.operators.joins import exists_flag
from lakeops.operators.ranking import top_k

N = 30_000
T0 = datetime(2024, 1, 1)


def rows():
    out = []
    for i in range(N):
        key = 0 if i % 3 == 0 else i  # key 0: a third of all rows
        out.append((key, i, T0 + timedelta(seconds=(i * 7919) % N), (i * 31) % 97))
    return out


@pytest.fixture(scope="module")
def hot(spark):
    return spark.createDataFrame(rows(), "k long, i long, ts timestamp_ntz, v int").repartition(16)


def test_latest_by_hot_key(hot):
    expected = {}
    for k, i, ts, v in rows():
        if k not in expected or (ts, i) > expected[k]:
            expected[k] = (ts, i)
    got = {r.k: (r.ts, r.i) for r in latest_by(hot, ["k"], "ts", ["i"]).collect()}
    assert got == expected


def test_counts_hot_key(hot):
    expected = Counter(k for k, *_ in rows())
    got = {r.k: r.n for r in counts_by(hot, ["k"], "n").collect()}
    assert got == expected and got[0] == N // 3


def test_unique_and_relationship_hot_key(spark, hot):
    parent = spark.createDataFrame([(k,) for k in range(1, N, 2)], "k long")
    res = {r.check: r for r in C.run_checks(hot, "t", [C.unique("k"), C.relationship("k", parent, "k", "p")]).collect()}
    counts = Counter(k for k, *_ in rows())
    assert res["unique"].unexpected == sum(c for c in counts.values() if c > 1)
    parents = set(range(1, N, 2))
    assert res["relationship"].unexpected == sum(c for k, c in counts.items() if k not in parents)
    assert res["relationship"].observed == N


def test_top_k_hot_group(hot):
    groups = defaultdict(list)
    for k, i, ts, v in rows():
        groups[k].append((v, i))
    expected = {k: sorted(g)[:5] for k, g in groups.items()}
    out = top_k(hot, ["k"], [F.col("v").asc(), F.col("i").asc()], 5, "rank").collect()
    got = defaultdict(list)
    for r in out:
        got[r.k].append((r.rank, r.v, r.i))
    assert {k: [(v, i) for _, v, i in sorted(g)] for k, g in got.items()} == expected


def test_exists_flag_never_multiplies_rows(spark, hot):
    left = spark.createDataFrame([(k,) for k in range(0, 100)], "k long")
    out = exists_flag(left, hot, "k", "seen").collect()
    assert len(out) == 100
    present = {k for k, *_ in rows()}
    assert {r.k: r.seen for r in out} == {k: k in present for k in range(100)}
