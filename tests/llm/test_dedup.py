import numpy as np
import pytest

from lakeops.llm import simhash, suffix_dedup
from lakeops.llm.components import components
from . import brute


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_every_link_meets_at_a_home_anchor():
    rng = np.random.default_rng(1)
    x = rng.integers(-(2**63), 2**63, 500, dtype=np.int64)
    for code in ((simhash.GOLAY, simhash.GOLAY), (simhash.GOLAY, simhash.GOLAY, simhash.HAMMING)):
        row, anchor = simhash.replicas(x, code, 2)
        met = set(zip(row.tolist(), anchor.tolist()))
        for flips in (1, 2):
            y = x.view(np.uint64).copy()
            for _ in range(flips):
                y ^= np.uint64(1) << rng.integers(0, 64, len(x)).astype(np.uint64)
            at, home = simhash.replicas(y.view(np.int64), code, 0)
            assert at.tolist() == list(range(len(x)))
            assert all((k, h) in met for k, h in enumerate(home.tolist()))


def test_fingerprint_equals_its_definition():
    for _, text, *_ in brute.DOCS:
        if text is None or len(text) < 5000:
            assert simhash.fingerprint((text or "").encode()) % 2**64 == brute.fingerprint(text)


@pytest.mark.parametrize("crowd", [0, 16])
def test_links_equal_brute_force_in_crowds_too(spark, crowd):
    rng = np.random.default_rng(2)
    centre = rng.integers(0, 2**63, 6)
    fps = {int(c) ^ (1 << int(a)) ^ (1 << int(b)) for c in centre for a, b in rng.integers(0, 62, (60, 2))}
    fps = sorted(fps | set(map(int, rng.integers(0, 2**63, 100))))
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    got = {r["node"]: r["root"] for r in components(simhash.links(df, crowd=crowd)).collect()}
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, a in enumerate(fps):
        for b in fps[k + 1 :]:
            if (a ^ b).bit_count() <= 2 and find(a) != find(b):
                lo, hi = sorted((find(a), find(b)))
                parent[hi] = lo
    assert all(got.get(f, f) == find(f) for f in fps)


def test_near_duplicates_equal_brute_force(spark, documents):
    got = {r[0]: (r[1], r[2]) for r in simhash.near_duplicates(documents).collect()}
    assert got == brute.components(pairs(documents))


def test_near_duplicates_of_odd_rows(spark, odd):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    got = {r[0]: (r[1], r[2]) for r in rows if r[0] is not None}
    assert got == brute.components([p for p in pairs(odd) if p[0] is not None])
    assert simhash.near_duplicates(odd.limit(0)).count() == 0
    kept = simhash.without_near_duplicates(odd)
    assert kept.columns == odd.columns
    ids = sorted((r["doc_id"] for r in kept.collect()), key=str)
    first = {c for _, c in got.values()}
    assert ids == sorted([*first, None], key=str)


def test_components_of_a_long_chain(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001), (5, 5)], "a long, b long")
    got = {r["node"]: r["root"] for r in components(chain).collect()}
    assert got == {**dict.fromkeys(range(301), 0), 1000: 1000, 1001: 1000}


def test_longest_previous_factors():
    assert suffix_dedup.previous_smaller(np.array([3, 1, 2, 2, 0, 5])).tolist() == [-1, -1, 1, 1, -1, 4]
    windows = np.frombuffer((b"a" * 50 + b"b" * 50) * 2, np.uint8).reshape(4, 50)
    assert suffix_dedup.earlier_matches(windows, np.array([4, 2, 1, 2])).tolist() == [True, False, False, False]


@pytest.mark.parametrize("crowd", [0, 64])
def test_repeats_equal_brute_force(spark, documents, crowd):
    some = documents.repartition(5)
    got = sorted([tuple(r) for r in suffix_dedup.remove_repeats(some, ["doc_id"], kept="kept_sha256", crowd=crowd).collect()], key=str)
    assert got == brute.without_repeats(pairs(documents))


def test_repeats_of_odd_rows(spark, odd):
    got = sorted([tuple(r) for r in suffix_dedup.remove_repeats(odd, ["doc_id"], kept="kept_sha256").collect()], key=str)
    assert got == brute.without_repeats(pairs(odd))
    assert suffix_dedup.remove_repeats(odd.limit(0), ["doc_id"]).count() == 0
    whole = suffix_dedup.without_repeats(odd)
    assert whole.columns == odd.columns and whole.count() == odd.count()
    second = whole.where("doc_id = 2").first()
    assert brute.PASSAGE[:40] not in second["text"] and second["n_chars"] == len(second["text"])
