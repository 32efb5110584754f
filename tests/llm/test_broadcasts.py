"""Findings F1 and F2 of FINDINGS_r04.md: what grows with the input is not broadcast, however small Spark sizes it."""

import pytest

from lakeops.llm import simhash, suffix_dedup

REPEATED = " ".join(f"common{i}" for i in range(40))


@pytest.fixture
def few(spark, tmp_path):
    """Rows of files far below the threshold; one doc_id is there twice."""
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(30)) + " " + REPEATED) for i in range(200)]
    rows += [(0, "another text of the first one"), (300, rows[5][1]), (None, rows[5][1])]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
    yield spark.read.parquet(f"{tmp_path}/documents")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def broadcasts(df):
    """What is below each broadcast of the plan."""
    lines = df._jdf.queryExecution().executedPlan().toString().split("\n")
    depth = [len(x) - len(x.lstrip(" :+-*()0123456789")) for x in lines]
    found = []
    for i, line in enumerate(lines):
        if "BroadcastExchange" in line:
            end = next((k for k in range(i + 1, len(lines)) if depth[k] <= depth[i]), len(lines))
            found.append("\n".join(lines[i:end]))
    return found


@pytest.fixture
def plans(monkeypatch):
    """The plans of tables that operators write, by name."""
    found = {}
    for module in (simhash, suffix_dedup):

        def written(df, name, f=module.written):
            found[name] = df
            return f(df, name)

        monkeypatch.setattr(module, "written", written)
    return found


def test_replicas_of_fingerprints_are_not_broadcast(few, plans):
    result = simhash.near_duplicates(few)
    assert not any("MapInArrow" in x for x in broadcasts(plans["met"]))
    assert not any("llm-fingerprints" in x for x in broadcasts(result))
    got = {r["doc_id"]: r["component_id"] for r in result.collect() if r["doc_id"]}
    assert got == {i: i for i in range(1, 200)} | {300: 5}


def test_tables_of_a_row_per_document_are_not_broadcast(few, plans):
    result = simhash.without_near_duplicates(few)
    assert not any("MapInArrow" in x for x in broadcasts(plans["met"]))
    assert not any("llm-fingerprints" in x for x in broadcasts(plans["heads"]))
    # ids that heads and rows were merged on may be: a join is sized by the product of its sides
    assert not any("llm-heads" in x and "SortMergeJoin" not in x for x in broadcasts(result))
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in result.collect()) == [
        (False, 0), *((False, i) for i in range(200)), (True, 0)
    ]


def test_what_blocks_get_of_segments_is_not_broadcast(few, plans):
    result = suffix_dedup.remove_repeats(few, ["doc_id"])
    assert not any("collect_list" in x for name in ("marked", "answers") for x in broadcasts(plans[name]))
    removed = {r["doc_id"]: r["n_removed"] for r in result.where("n_bytes > 100").collect() if r["doc_id"] is not None}
    assert removed[0] == 0 and all(removed[i] >= len(REPEATED) for i in [*range(1, 200), 300])
