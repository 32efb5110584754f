"""Every registered query against its DuckDB oracle on the smallest test tables."""

import math
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
VIEWS = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
ORACLE = entry.oracle_sql()


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    if isinstance(v, Decimal):
        return v.normalize()
    return v


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for v in VIEWS:
        con.execute(f"CREATE VIEW {v} AS SELECT * FROM read_parquet('{Path(SF) / (v + '.parquet')}')")
    return con


@pytest.mark.parametrize("key", sorted(entry.queries()))
def test_query_matches_oracle(spark, duck, key):
    df = entry.queries()[key](spark, SF)
    cols, rows = df.columns, [tuple(r) for r in df.collect()]
    if key not in ORACLE:
        assert len(rows) > 0
        return
    res = duck.execute(ORACLE[key])
    o_cols = [d[0] for d in res.description]
    o_rows = res.fetchall()
    assert sorted(cols) == sorted(o_cols)
    assert len(rows) == len(o_rows)
    assert _bag(cols, rows) == _bag(o_cols, o_rows)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "cpl" in df.columns
