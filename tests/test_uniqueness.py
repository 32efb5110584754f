"""Uniqueness in two passes: the same rows as one aggregate by key, and far fewer bytes through the shuffle."""

import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakeops.operators import checks as C
from lakeops.operators import uniqueness as U


@given(st.lists(st.integers(0, 2**64 - 1), min_size=1, max_size=200))
@settings(max_examples=60, deadline=None)
def test_packed_slots_come_back(values):
    slots = np.sort(np.array(values, np.uint64))
    base = int(slots[0]) // 2
    assert U.unpack(U.pack(slots, base), len(slots), base).tolist() == slots.tolist()


def test_slots_bound_chance_at_any_size():
    for exponent in range(0, 41):
        n = 1 << exponent
        bits = U.slot_bits(n)
        assert exponent <= bits <= 64 and 0 <= U.band_bits(n) <= bits
        assert n * n / 2 ** (bits + 1) <= U.CHANCE_SLOTS
        assert n / 2 ** U.band_bits(n) <= U.BAND_KEYS


def _rows(seed):
    rng = random.Random(seed)
    out = [(i, f"k{i}", float(i)) for i in range(4000)]
    out += [(rng.randrange(4000), f"k{rng.randrange(4000)}", -0.0) for _ in range(300)]
    out += [(7, None, 0.0), (None, "k1", float("nan")), (None, None, float("nan")), (7, "k7", None)]
    out += [(7, "hot", 1.5)] * 2000  # a third of the rows on one key
    return out


def _expected(rows, places):
    keys = Counter(tuple(str(r[p] + 0.0) if isinstance(r[p], float) else r[p] for p in places) for r in rows)
    return {k: n for k, n in keys.items() if n > 1 and None not in k}


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(_rows(1), "id long, name string, value double").repartition(7)


@pytest.mark.parametrize("columns", [["id"], ["name"], ["value"], ["id", "name"]])
@pytest.mark.parametrize("small", [False, True])
def test_repeated_keys_equal_a_count_by_key(table, columns, small, monkeypatch):
    if small:  # several chunks a task, several bands, many slots met by chance
        monkeypatch.setattr(U, "CHUNK_KEYS", 100)
        monkeypatch.setattr(U, "BAND_KEYS", 500)
        monkeypatch.setattr(U, "slot_bits", lambda rows: 13)
    got = {tuple(str(v + 0.0) if isinstance(v, float) else v for v in r[:-1]): r[-1] for r in U.repeated_keys(table, columns).collect()}
    assert got == _expected(_rows(1), [table.columns.index(c) for c in columns])


def test_too_many_candidates_are_counted_by_one_aggregate(table, monkeypatch):
    monkeypatch.setattr(U, "HELD_SLOTS", 3)
    found = U.find_repeats(table, [["id"]])[0]
    assert found.candidates is None and found.found > 3
    assert {(r.id,): r.rows for r in found.keys().collect()} == _expected(_rows(1), [0])


def test_all_bits_of_the_hash(table, monkeypatch):
    monkeypatch.setattr(U, "slot_bits", lambda rows: 64)
    assert {(r.id,): r.rows for r in U.repeated_keys(table, ["id"]).collect()} == _expected(_rows(1), [0])


def test_empty_and_null_keys_have_no_repeats(spark):
    empty = spark.createDataFrame([], "k long, `a.b` string")
    assert U.repeated_keys(empty, ["k", "a.b"]).columns == ["k", "a.b", "rows"]
    assert U.repeated_keys(empty, ["k"]).count() == 0
    nulls = spark.createDataFrame([(None, "x"), (None, "x")], "k long, `a.b` string")
    assert U.repeated_keys(nulls, ["k"]).count() == 0
    assert [tuple(r) for r in U.repeated_keys(nulls, ["a.b"]).collect()] == [("x", 2)]
    with pytest.raises(ValueError):
        U.repeated_keys(nulls.withColumnRenamed("k", "rows"), ["rows"])


def test_checks_give_the_same_rows_either_way(spark, table):
    parent = spark.createDataFrame([(i,) for i in range(0, 4000, 2)], "id long")
    checks = [C.unique("id"), C.unique("name"), C.unique("value"), C.not_null("name"), C.row_count_min(5)]
    checks.append(C.relationship("id", parent, "id", "parent"))
    once = {tuple(r) for r in C.run_checks(table, "t", checks).collect()}
    assert {tuple(r) for r in C.run_checks(table, "t", checks, two_pass=True).collect()} == once
    only = {tuple(r) for r in C.run_checks(table, "t", [C.unique("name")], two_pass=True).collect()}
    assert only < once and len(only) == 1


def test_a_unique_key_sends_few_bytes(spark):
    """A surrogate key (32 characters): under a tenth of what its rows of (key, count) hold."""
    n = 400_000
    keys = spark.range(n, numPartitions=4).select(F.md5(F.col("id").cast("string")).alias("k"))
    packed = U.packed_slots(keys, [["k"]], [n]).agg(F.sum("slots").alias("slots"), F.sum(F.length("gaps") + 24).alias("bytes")).first()
    assert packed.slots == n
    assert packed.bytes / n < (32 + 8) / 10
    assert U.find_repeats(keys, [["k"]])[0].rows == n
