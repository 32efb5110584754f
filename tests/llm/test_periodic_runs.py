import hashlib
import random
import re
import time
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakeops.llm import periodic_runs as pr
from lakeops.llm.queries import QUERIES

from .conftest import SF

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def smallest_period(w):
    return next(q for q in range(1, len(w) + 1) if all(w[i] == w[i + q] for i in range(len(w) - q)))


def brute_runs(w):
    """All lags, all stretches."""
    found = []
    for q in range(1, len(w) // 3 + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            length = i + q - s
            if length >= max(24, 3 * q) and smallest_period(w[s : s + length]) == q:
                found.append((s, length, q))
    return sorted(found)


def planted(doc_id, words):
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def brute(words):
    runs = brute_runs(words)
    dropped = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None, None, None)
    return {
        "n_runs": len(runs),
        "start": best[0],
        "length": best[1],
        "period": best[2],
        "exponent_milli": 1000 * best[1] // best[2] if runs else None,
        "runs_sha256": hashlib.sha256("".join("%d,%d,%d\n" % r for r in runs).encode()).hexdigest(),
        "collapsed_sha256": hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in dropped).encode()).hexdigest(),
    }


def runs(words):
    return [tuple(r) for r in pr.find_runs(np.array(words, np.int64)).tolist()]


@st.composite
def repetitive(draw):
    """Pieces of few words, repeated, nested and cut."""
    letters = st.lists(st.integers(0, 2), min_size=1, max_size=9)
    words = []
    for _ in range(draw(st.integers(1, 4))):
        piece = draw(letters)
        inner = piece * draw(st.integers(1, 9)) + draw(letters)
        whole = inner * draw(st.integers(1, 6))
        words += whole[: draw(st.integers(0, len(whole)))] + draw(letters)
    return words


@settings(max_examples=400, deadline=None)
@given(repetitive())
def test_runs_equal_all_lags(words):
    assert runs(words) == brute_runs(words)


def test_structured_words():
    """Words in which grams repeat inside the period: Fibonacci, Thue-Morse, near repeats."""
    fib = ["0", "01"]
    while len(fib[-1]) < 300:
        fib.append(fib[-1] + fib[-2])
    morse = [bin(i).count("1") % 2 for i in range(256)]
    rng = random.Random(3)
    cases = [list(map(int, fib[-1])), morse * 3, [*morse[:50], 2] * 4, [0] * 500, [0] * 23, [0] * 24, [0, 1] * 12]
    for q in (7, 8, 15, 16, 17, 31, 32, 33, 64, 100):
        block = [rng.randrange(3) for _ in range(q)]
        cases += [block * 3, (block * 3)[:-1], [9, *block * 3, 9], (block * 4)[: 3 * q + 1]]
        half = block[: q // 2]
        cases += [[*half, *half, 5] * 4, [*half, *half, *half, 5] * 3 + half]
    for words in cases:
        assert runs(words) == brute_runs(words)


def test_long_runs_take_linear_time():
    begin = time.monotonic()
    n = 400_000
    assert runs([7] * n) == [(0, n, 1)]
    block = list(range(1000))
    assert runs(block * 400) == [(0, n, 1000)]
    assert time.monotonic() - begin < 20


def test_documents(spark, documents, odd):
    extra = spark.createDataFrame(
        [(20, "ab cd " * 40 + "x"), (21, "a " * 23), (22, "a " * 24), (23, ("p q r s t u v w x " * 3).strip()), (24, "é " * 30)],
        "doc_id long, text string",
    )
    digests = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    for docs in (documents.where("length(text) < 3000"), odd.where("coalesce(length(text), 0) < 3000"), extra):
        for size in (1 << 20, 100):
            out = pr.detect(docs, docs.columns, (*digests, "runs", "collapsed"), block_bytes=size)
            for r in out.collect():
                want = brute(WORD.findall(r["text"] or ""))
                assert {c: r[c] for c in digests} == want
                assert hashlib.sha256(r["collapsed"].encode()).hexdigest() == want["collapsed_sha256"]
                assert [tuple(x) for x in r["runs"]] == brute_runs(WORD.findall(r["text"] or ""))
    long = [r for r in pr.detect(odd, ["doc_id"], ("n_runs", "period", "length")).collect() if r["doc_id"] in (6, 7)]
    assert [(r["n_runs"], r["period"], r["length"]) for r in long] == [(1, 5, 15000)] * 2
    assert pr.detect(odd.limit(0), ["doc_id"]).count() == 0


def test_bytes_that_are_not_utf8(spark):
    docs = spark.sql("SELECT 1 AS doc_id, CAST(X'61FF2062' AS STRING) AS text")
    (row,) = pr.detect(docs, ["doc_id"]).collect()
    assert row["n_runs"] == 0 and row["collapsed"] == "a� b"


def test_planting(spark):
    docs = spark.range(300).selectExpr("id AS doc_id", "array_join(transform(sequence(1, id % 70), x -> 'w' || x), '  ') AS text")
    docs = docs.unionByName(spark.sql("SELECT CAST(NULL AS LONG) AS doc_id, 'a b' AS text UNION ALL SELECT 11, NULL UNION ALL SELECT 12, ' '"))
    kept = docs.select(F.col("doc_id"), F.col("text").alias("was"), "text")
    changed = 0
    for r in pr.with_planted_runs(kept).collect():
        before = WORD.findall(r["was"] or "")
        after = WORD.findall(r["text"] or "")
        assert after == planted(r["doc_id"], before)
        changed += after != before
    assert changed > 10


def test_query(spark):
    out = {r["doc_id"]: r for r in QUERIES["op12_periodic_runs"](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert len(out) == len(docs)
    for r in docs:
        words = planted(r["doc_id"], WORD.findall(r["text"] or ""))
        if len(words) < 3000:
            got = out[r["doc_id"]].asDict()
            assert {c: v for c, v in got.items() if c != "doc_id"} == brute(words)
    assert sum(r["n_runs"] for r in out.values()) > 5
