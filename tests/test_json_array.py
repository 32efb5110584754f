"""The splittable JSON array reader against json.loads."""

import json
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from lakeops.sources import json_array as ja

text = st.text(alphabet='ab"\\[]{},:é漢 \n', max_size=12)
value = st.one_of(text, st.integers(-9, 9), st.none(), st.lists(text, max_size=3), st.dictionaries(text, text, max_size=2))
arrays = st.lists(st.dictionaries(text, value, max_size=3), max_size=8)


def by_blocks(data, size):
    """Both passes on one byte string."""
    state, depth, found = ja.OUTSIDE, 0, []
    for start in range(0, len(data), size):
        own, whole, length = min(size, len(data) - start), False, min(size, len(data) - start)
        while not whole:
            got, whole = ja.objects(data[start : start + length], state, depth, own)
            assert whole or start + length < len(data)
            length += size
        found += got
        state, change = ja.effect(data[start : start + size])[state]
        depth += change
    assert (state, depth) == (ja.OUTSIDE, 0)
    return [json.loads(x) for x in found]


@settings(max_examples=300, deadline=None)
@given(arrays, st.integers(1, 40), st.sampled_from([None, 1]), st.booleans())
def test_blocks_of_any_size_give_the_objects(rows, size, indent, ascii_):
    data = (" \n" + json.dumps(rows, indent=indent, ensure_ascii=ascii_) + "\n").encode()
    assert by_blocks(data, size) == rows


SCHEMA = T.StructType(
    [T.StructField("id", T.LongType()), T.StructField("s", T.StringType()), T.StructField("l", T.ArrayType(T.StringType()))]
)


def rows_of(seed, n=400):
    rng = random.Random(seed)
    pieces = ['"', "\\", "[", "]", "{", "}", ",", "\\\\", '\\"', "é", "漢字", "\n", "plain"]
    return [
        {"id": i, "s": "".join(rng.choices(pieces, k=rng.randrange(9))), "l": ["}", '{"', "]"][: rng.randrange(4)], "more": {"x": [1]}}
        for i in range(n)
    ]


def test_one_file_is_read_by_several_tasks(spark, tmp_path):
    files = {"a.json": rows_of(1), "b.json": rows_of(2, 7), "c.json": [], "d.json": [{"id": 1, "s": "x" * 5000, "l": None}, {"id": 2}]}
    for name, rows in files.items():
        (tmp_path / name).write_text(json.dumps(rows, ensure_ascii=False, indent=1 if name == "a.json" else None))
    want = sorted(((r.get("id"), r.get("s"), tuple(r["l"]) if r.get("l") is not None else None) for rows in files.values() for r in rows), key=repr)
    for size in (97, 1 << 20):
        df = ja.read_json_array_split(spark, str(tmp_path), SCHEMA, block_bytes=size)
        got = sorted(((r["id"], r["s"], tuple(r["l"]) if r["l"] is not None else None) for r in df.collect()), key=repr)
        assert got == want
        if size == 97:
            assert df.rdd.getNumPartitions() > 8
    only = ja.read_json_array_split(spark, str(tmp_path / "c.json"), SCHEMA)
    assert only.columns == ["id", "s", "l"] and only.count() == 0
    (tmp_path / "none.json").write_text("")
    assert ja.read_json_array_split(spark, str(tmp_path / "none.json"), SCHEMA).count() == 0


@pytest.mark.parametrize("text", ['[{"id": 1}', '[{"id": 1}, {"s": "open', " ", "{}", '[{"id": 1}, 2]', '[[1]]', '[{"id": "no number"}]'])
def test_bad_files_fail(spark, tmp_path, text):
    (tmp_path / "bad.json").write_text(text)
    for size in (3, 1000):
        with pytest.raises(Exception, match="not complete|no object|MALFORMED|Malformed|malformed|CANNOT|FAILFAST"):
            ja.read_json_array_split(spark, str(tmp_path / "bad.json"), SCHEMA, block_bytes=size).collect()


def test_missing_path(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        ja.read_json_array_split(spark, str(tmp_path / "gone.json"))


def slowly(data, state):
    """`effect` for one state, byte by byte."""
    depth = 0
    for byte in data.decode("latin-1"):
        if state == ja.ESCAPED:
            state = ja.INSIDE
        elif state == ja.INSIDE:
            state = ja.OUTSIDE if byte == '"' else ja.ESCAPED if byte == "\\" else ja.INSIDE
        else:
            state = ja.INSIDE if byte == '"' else state
            depth += {"[": 1, "{": 1, "]": -1, "}": -1}.get(byte, 0)
    return state, depth


@settings(max_examples=300, deadline=None)
@given(arrays, st.integers(0, 60), st.integers(0, 60))
def test_effect_is_that_of_the_bytes_one_by_one(rows, start, length):
    data = json.dumps(rows).encode()
    state, _ = slowly(data[:start], ja.OUTSIDE)
    assert ja.effect(data[start : start + length])[state] == slowly(data[start : start + length], state)
    if b"\\" not in data:  # then a block may begin in any state
        for state in (ja.OUTSIDE, ja.INSIDE, ja.ESCAPED):
            assert ja.effect(data[start : start + length])[state] == slowly(data[start : start + length], state)


def test_small_blocks_do_not_make_small_tasks(spark, tmp_path):
    rows = [{"id": i, "s": "x" * 50} for i in range(4000)]
    (tmp_path / "a.json").write_text(json.dumps(rows))
    df = ja.read_json_array_split(spark, str(tmp_path / "a.json"), SCHEMA, block_bytes=200)
    assert 1 < df.rdd.getNumPartitions() <= 4 * spark.sparkContext.defaultParallelism
    assert sorted(r.id for r in df.collect()) == list(range(4000))


def test_rankings_land_without_a_shuffle_into_few_files(spark, monkeypatch):
    """Every task writes its rows as one array, so writing grows with the tasks that read; tasks without rows write ``[]``."""
    from lakeops.plans import queries as Q

    raw = spark.range(0, 70, 1, 7).selectExpr(
        "id AS client_id", "concat('k\"', id) AS keyword", "CAST(id AS INT) AS position", "'2024-01-01' AS snapshot_date", "1 AS _dlt_load_time"
    )
    monkeypatch.setattr(Q.Models, "raw", lambda self, name: raw.where("client_id >= 10"))
    read = []
    monkeypatch.setattr(Q, "read_json_array_split", lambda s, path, **kw: read.append(path) or ja.read_json_array_split(s, path, **kw))
    got = Q.q_json_array_scan(spark, "nowhere")
    assert sorted((r.client_id, r.keyword) for r in got.collect()) == [(i, f'k"{i}') for i in range(10, 70)]
    files = [json.loads(r.value) for r in spark.read.text(read[0], wholetext=True).collect()]
    assert sorted(map(len, files)) == [0, 10, 10, 10, 10, 10, 10]
