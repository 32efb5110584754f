"""Periodic runs of words by seed and extend on diagonals.

A run is a stretch of consecutive words with smallest period q (words q apart are equal) and length
at least max(``least``, ``copies`` * q) that no neighbour extends. On diagonal q (the lag) its words
match over length - q places, at least 2 * q and at least 16 (with 24 words and 3 copies).

1. Index: the k-grams of all places get exact ranks by doubling: a gram of 2k words is the pair of the
   ranks of its halves. Places whose gram does not occur again in the same document leave the index.
   k is the minimum overlap that a class of lags guarantees: 16 for lags below 16, then 2 * m for
   lags m to 2 * m - 1.
2. Seeds: the pairs of an occurrence of a gram and the next one in the same document, where their lag
   is in the class. These suffice: some gram of a run of period q has no period below min(q, k / 2)
   (else, by Fine and Wilf, the run had a smaller one). Occurrences of that gram lie at least so far
   apart, and one between places i and i + q would give the gram a smaller period; so the occurrence
   at i + q is the next one. There are never more seeds than places, however often a gram occurs.
3. Extension: a seed is extended left and right along its diagonal until words differ. A table of the
   furthest covered place per lag suppresses seeds inside what is already extended.
4. Stretches found at several lags have the smallest; the others are its multiples.

Documents are handled in blocks, each document wholly in one; the work is O(n log n) in a block's words.

Defined cases: a null or empty text, or one of white space only, has no words and no runs; bytes that are not UTF-8
stay as they are in words and are U+FFFD in ``collapsed``. Very long texts are handled whole. Ties of the
greatest exponent go to the smallest start, then period. Repeated rows are handled each. Carried columns
are passed on and never read; the output wins over a carried column of its name. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, release, slices

LEAST, COPIES = 24, 3  # words of a run, copies of its period
BLOCK_BYTES = 8 << 20
_STEP = 64  # words compared at first when a seed is extended


def _ranks(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal keys get equal ranks from 0 up; how often each rank occurs."""
    _, ranks, counts = np.unique(keys, return_inverse=True, return_counts=True)
    return ranks, counts


def _again(places: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places (ascending) whose key occurs again, and the ranks of their keys."""
    ranks, counts = _ranks(keys)
    held = counts[ranks] > 1
    return places[held], ranks[held]


def _doubled(places: np.ndarray, ranks: np.ndarray, k: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """From repeated k-grams to repeated 2k-grams."""
    at = np.searchsorted(places, places + k)
    at[at == len(places)] = 0
    whole = (places[at] == places + k) if len(places) else np.zeros(0, bool)
    left, right = ranks[whole].astype(np.int64), ranks[at[whole]].astype(np.int64)
    return _again(places[whole], left * (n + 1) + right)


def _seeds(places: np.ndarray, ranks: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """(lag, place) of each occurrence and the next one of its gram, for lags from low to high - 1, by lag and place."""
    order = np.argsort(ranks, kind="stable")
    sorted_, rank = places[order], ranks[order]
    lag = np.diff(sorted_)
    near = (rank[1:] == rank[:-1]) & (lag >= low) & (lag < high)
    lag, place = lag[near], sorted_[:-1][near]
    order = np.lexsort((place, lag))
    return lag[order], place[order]


def _reach(words: np.ndarray, place: int, lag: int, step: int, most: int) -> int:
    """How many places from ``place`` on (step 1) or back (step -1) match those ``lag`` later, ``most`` at most."""
    done, width = 0, _STEP
    while done < most:
        n = min(width, most - done)
        if step > 0:
            a = place + done
            same = words[a : a + n] == words[a + lag : a + lag + n]
        else:
            a = place - done - n + 1
            same = (words[a : a + n] == words[a + lag : a + lag + n])[::-1]
        if not same.all():
            return done + int(same.argmin())
        done, width = done + n, width * 2
    return done


def find_runs(words: np.ndarray, least: int = LEAST, copies: int = COPIES) -> np.ndarray:
    """(start, length, period) rows of all runs, by start and period.

    ``words`` are whole numbers; words of different documents have to differ, so that no run spans two.
    """
    if copies < 3 or least < 24:
        raise ValueError("the grams of the index are for 24 words and 3 copies at least")
    n = len(words)
    words, counts = _ranks(words)
    places = np.flatnonzero(counts[words] > 1)
    ranks = words[places]
    found: dict[tuple[int, int], int] = {}
    for k in (1, 2, 4, 8):
        places, ranks = _doubled(places, ranks, k, n)
    k, low = 16, 1
    while len(places):
        covered: dict[int, int] = {}  # lag -> first place that no extension has reached
        for lag, place in zip(*(x.tolist() for x in _seeds(places, ranks, low, k)), strict=True):
            if place < covered.get(lag, 0):
                continue
            start = place - _reach(words, place - 1, lag, -1, place)
            end = place + _reach(words, place, lag, 1, n - lag - place)
            covered[lag] = end
            length = end - start + lag
            if length >= max(least, copies * lag):
                key = (start, length)
                found[key] = min(lag, found.get(key, lag))
        places, ranks = _doubled(places, ranks, k, n)
        low, k = k, 2 * k
    return np.array(sorted((s, m, q) for (s, m), q in found.items()), np.int64).reshape(-1, 3)


def _words(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts in one array, and how many each text has."""
    split = pc.ascii_split_whitespace(pc.fill_null(column.cast(pa.large_binary()), b"").cast(pa.large_string(), safe=False))
    flat, of = split.flatten(), pc.list_parent_indices(split)
    real = pc.not_equal(pc.binary_length(flat), 0)
    counts = np.bincount(of.filter(real).to_numpy(), minlength=len(column))
    return flat.filter(real), counts


def _greatest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int]:
    best = runs[0]  # by start and period, so a later one has to be greater
    for run in runs[1:]:
        if run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


RUN = "struct<start: bigint, length: bigint, period: bigint>"
OUTPUT = {
    "n_runs": "long",
    "start": "long",
    "length": "long",
    "period": "long",
    "exponent_milli": "long",
    "runs": f"array<{RUN}>",
    "collapsed": "string",
    "runs_sha256": "string",
    "collapsed_sha256": "string",
}
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_ARROW = {"long": pa.int64(), "string": pa.string(), OUTPUT["runs"]: pa.list_(_RUN)}


def detect(
    docs: DataFrame,
    carry: list[str],
    output: tuple[str, ...] = ("n_runs", "runs", "collapsed"),
    text: str = "text",
    least: int = LEAST,
    copies: int = COPIES,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The ``carry`` columns and the ``output`` columns asked for.

    n_runs; runs (by start, then period; words numbered from 0); start, length, period and exponent_milli
    (thousandths of length / period) of the run of the greatest exponent, null without runs; collapsed (the text
    without words that lie in a run after its first period, joined by one space); runs_sha256 (of
    ``start,length,period`` lines) and collapsed_sha256 (lowercase hex).
    """
    carry = [c for c in carry if c not in output]

    def rows(column: pa.Array) -> Iterator[dict]:
        flat, counts = _words(column)
        ids = flat.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
        doc = np.repeat(np.arange(len(counts)), counts)
        size = int(ids.max()) + 1 if len(ids) else 1
        runs = find_runs(doc * size + ids, least, copies)
        ends = np.cumsum(counts)
        starts = ends - counts
        owner = np.searchsorted(ends, runs[:, 0], side="right")
        change = np.zeros(len(ids) + 1, np.int64)
        np.add.at(change, runs[:, 0] + runs[:, 2], 1)
        np.add.at(change, runs[:, 0] + runs[:, 1], -1)
        kept = np.cumsum(change)[:-1] == 0
        left = np.concatenate([[0], np.cumsum(np.bincount(doc[kept], minlength=len(counts)))])
        whole = pa.LargeListArray.from_arrays(pa.array(left, pa.int64()), flat.filter(pa.array(kept)))
        collapsed = pc.binary_join(whole, pa.scalar(" ", pa.large_string())).cast(pa.large_binary()).to_pylist()
        per: dict[int, list[tuple[int, int, int]]] = {}
        for d, (s, m, q) in zip(owner.tolist(), runs.tolist(), strict=True):
            per.setdefault(d, []).append((s - int(starts[d]), m, q))
        for d, data in enumerate(collapsed):
            mine = per.get(d, [])
            s, m, q = _greatest(mine) if mine else (None, None, None)
            lines = "".join(f"{a},{b},{c}\n" for a, b, c in mine)
            row = {"n_runs": len(mine), "start": s, "length": m, "period": q, "exponent_milli": 1000 * m // q if mine else None}
            row["runs"] = [dict(zip(("start", "length", "period"), r, strict=True)) for r in mine]
            row["collapsed"] = data.decode("utf-8", "replace") if "collapsed" in output else None
            row["runs_sha256"] = sha256(lines.encode()).hexdigest()
            row["collapsed_sha256"] = sha256(data).hexdigest()
            yield row

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text, block_bytes):
            made: dict[str, list] = {c: [] for c in output}
            for row in rows(batch.column(text)):
                for c, values in made.items():
                    values.append(row[c])
            columns = [batch.column(c) for c in carry]
            columns += [pa.array(values, _ARROW[OUTPUT[c]]) for c, values in made.items()]
            yield pa.RecordBatch.from_arrays(columns, names=[*carry, *output])
        release()

    types = dict(docs.dtypes)
    schema = ", ".join([*(f"`{c}` {types[c]}" for c in carry), *(f"{c} {OUTPUT[c]}" for c in output)])
    return docs.select(*dict.fromkeys([*carry, text])).mapInArrow(run, schema)


def with_planted_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with a period planted in one of ten, as the query's contract fixes it.

    With h the crc32 of the decimal doc_id and g = h div 10: if h % 10 = 0, each of the n words from
    a = g % n on becomes the word a + (i - a) % p, p = 1 + (n - a) div (3 + g % 8). A null doc_id is never chosen.
    """
    h = F.crc32(F.col(doc_id).cast("string"))
    spec = """element_at(transform(array(named_struct('w', regexp_extract_all({text}, '{word}', 0), 'g', {h} div 10)), s ->
        CASE WHEN size(s.w) > 0 THEN
            element_at(transform(array(named_struct('a', s.g % size(s.w),
                'p', 1 + (size(s.w) - s.g % size(s.w)) div (3 + s.g % 8))), c ->
                array_join(transform(s.w, (x, i) -> if(i < c.a, x, s.w[CAST(c.a + (i - c.a) % c.p AS INT)])), ' ')), 1)
        ELSE {text} END), 1)"""
    word = WORD.replace("\\", "\\\\")
    planted = F.expr(spec.format(text=f"`{text}`", word=word, h=f"crc32(CAST(`{doc_id}` AS STRING))"))
    return docs.withColumn(text, F.when(h % 10 == 0, planted).otherwise(F.col(text)))
