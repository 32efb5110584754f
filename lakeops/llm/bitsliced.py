"""Exact top-k inner products over a bit-sliced index.

Vectors are quantised to integers. A block of rows is indexed as bitmaps: bit k of attribute j of
all rows of the block is one bitmap (a slice). For a query the weighted sum of the attributes is
built by bitmap arithmetic: every non-zero digit of a weight (signed binary digits, so that few are
non-zero) adds the attribute's slices, shifted, to the slices of the sum with a ripple of full
adders; a negative digit adds the complement. Only the upper ``COARSE`` slices of each attribute are
added; what the lower ones can contribute is bounded by the weights.

The k-th largest sum is found from the most significant slice downward with counts of bitmaps. Rows
that could still be among the first k, given the bound, are the boundary; their exact integer scores
are taken from all slices and ranked. So the result is exact for any data.

Work: queries x blocks. Queries travel in chunks to the blocks as binary rows through two equality
joins; each pair of a chunk and a block gives at most k rows per query, and a window with a group
limit keeps the best k. Blocks are dealt by a hash of the id, so a vector that very many rows share
spreads over all blocks.

Defined cases: a null vector, or one with a null or non-finite component, takes no part, nor does a
null id. Rows of one id are rows of their own: each is a candidate of all others and, if its id is asked
for, a query of its own, with results of its own under that id. Shorter vectors are continued with
zeros. Ties go to the smaller id. Other columns are not read, whatever their names. Empty tables give
empty results. A component whose quantised value, or a result whose score, is beyond the 64-bit range raises
an error; where sums could leave that range, scores of boundary rows are added in unbounded integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

SCALE = 1024
COARSE = 7
BLOCK_ROWS = 32768
CHUNK_QUERIES = 64
LANES = 8


def quantised(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(row, vec_id, q): a number of its own for each row once written, and the floored components times SCALE."""
    x = "CAST(x AS DOUBLE)"
    held = f"CASE WHEN abs({SCALE} * {x}) < {2.0**63!r}D THEN floor({SCALE} * {x}) ELSE CAST(raise_error('component beyond 64 bits') AS LONG) END"
    finite = f"x IS NOT NULL AND NOT isnan({x}) AND abs({x}) < CAST('Infinity' AS DOUBLE)"
    return (
        vectors.select(F.col(vec_id).alias("vec_id"), F.col(vector).alias("v"))
        .where(f"vec_id IS NOT NULL AND v IS NOT NULL AND forall(v, x -> {finite})")
        .selectExpr("monotonically_increasing_id() AS row", "CAST(vec_id AS LONG) AS vec_id", f"transform(v, x -> {held}) AS q")
    )


def _matrix(rows: pd.Series) -> np.ndarray:
    width = max(map(len, rows), default=0)
    if all(len(r) == width for r in rows):
        return np.array(rows.tolist(), np.int64).reshape(len(rows), width)
    out = np.zeros((len(rows), width), np.int64)
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out


class Slices:
    """The bit-sliced index of one block."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, low: np.ndarray, bits: np.ndarray):
        self.rows, self.ids, self.low, self.bits = rows, ids, low, bits  # bits[attribute, k, word]

    @classmethod
    def build(cls, ids: np.ndarray, values: np.ndarray, rows: np.ndarray | None = None) -> Slices:
        low = values.min(axis=0) if values.size else np.zeros(values.shape[1], np.int64)
        above = (values.astype(np.uint64) - low.astype(np.uint64)).T  # below 2^64, so exact
        width = max(1, int(above.max(initial=0)).bit_length())
        words = -(-len(ids) // 64)
        bits = np.zeros((len(low), width, words * 8), np.uint8)
        for k in range(width):
            packed = np.packbits((above >> np.uint64(k) & np.uint64(1)).astype(np.uint8), axis=1, bitorder="little")
            bits[:, k, : packed.shape[1]] = packed
        return cls(np.arange(len(ids)) if rows is None else rows, ids, low, bits.view("<u8"))

    def values(self, rows: np.ndarray) -> np.ndarray:
        """Exact attribute values of some rows, (row, attribute)."""
        held = self.bits[:, :, rows >> 6] >> (rows & 63).astype(np.uint64) & np.uint64(1)
        weights = np.uint64(1) << np.arange(self.bits.shape[1], dtype=np.uint64)
        return (np.einsum("jkr,k->rj", held, weights) + self.low.astype(np.uint64)).view(np.int64)

    def most(self) -> list[int]:
        """A bound of the absolute value of each attribute."""
        high = (1 << self.bits.shape[1]) - 1
        return [max(abs(x), abs(x + high)) for x in self.low.tolist()]


def signed_digits(n: int) -> list[tuple[int, int]]:
    """(place, +1 or -1) of the digits of n in non-adjacent form."""
    out, place = [], 0
    while n:
        if n & 1:
            digit = 2 - (n & 3)
            out.append((place, digit))
            n -= digit
        n >>= 1
        place += 1
    return out


class Sums:
    """Slices of weighted sums, made by bitmap addition."""

    def __init__(self, index: Slices, query: np.ndarray):
        width = index.bits.shape[1]
        self.shift = max(0, width - COARSE)
        coarse = index.bits[:, self.shift :]
        attributes = min(len(query), len(index.low))
        weights = [int(w) for w in query[:attributes]]
        # digits and their complements add at most this much
        most = sum((1 << place) for w in weights for place, _ in signed_digits(w)) << coarse.shape[1]
        words = coarse.shape[2]
        self.sum = np.zeros((most.bit_length() + 1, words), np.uint64)
        flipped = np.bitwise_not(coarse)
        half, carry, both = (np.empty(words, np.uint64) for _ in range(3))
        for j, w in enumerate(weights):
            for place, digit in signed_digits(w):
                self._add(coarse[j] if digit > 0 else flipped[j], place, half, carry, both)
        # how far the lower slices can move a row's score, in units of the coarse sum
        self.slack = (sum(map(abs, weights)) * ((1 << self.shift) - 1) >> self.shift) + 1
        self.all = np.full(words, ~np.uint64(0))
        if tail := len(index.ids) % 64:
            self.all[-1] = np.uint64((1 << tail) - 1)

    def _add(self, slices: np.ndarray, place: int, half: np.ndarray, carry: np.ndarray, both: np.ndarray) -> None:
        carry.fill(0)
        for k in range(len(slices)):
            at = self.sum[place + k]
            np.bitwise_xor(at, slices[k], out=half)
            np.bitwise_and(at, slices[k], out=both)
            np.bitwise_xor(half, carry, out=at)
            np.bitwise_and(half, carry, out=carry)
            np.bitwise_or(carry, both, out=carry)
        k = place + len(slices)
        while carry.any():
            at = self.sum[k]
            np.bitwise_and(at, carry, out=both)
            np.bitwise_xor(at, carry, out=at)
            carry, both = both, carry
            k += 1

    def kth(self, k: int) -> int:
        """The k-th largest sum (the smallest, if there are fewer rows)."""
        left, tied, value = k, self.all.copy(), 0
        for place in range(len(self.sum) - 1, -1, -1):
            ones = tied & self.sum[place]
            n = int(np.bitwise_count(ones).sum())
            if n >= left:
                tied, value = ones, value | 1 << place
            else:
                left -= n
                rest = tied & ~self.sum[place]
                if not rest.any():  # fewer than k rows: go on with the smallest of the ones
                    tied, left, value = ones, n, value | 1 << place
                else:
                    tied = rest
        return value

    def at_least(self, value: int) -> np.ndarray:
        """Row numbers whose sum is ``value`` or more."""
        if value <= 0:
            held = self.all
        else:
            more, tied = np.zeros_like(self.all), self.all.copy()
            for place in range(len(self.sum) - 1, -1, -1):
                if value >> place & 1:
                    tied &= self.sum[place]
                else:
                    more |= tied & self.sum[place]
                    tied &= ~self.sum[place]
            held = more | tied
        return np.flatnonzero(np.unpackbits(held.view(np.uint8), bitorder="little"))


def search(index: Slices, row: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and exact scores of the best k rows of a block, the query's own row left out."""
    if not len(index.ids):
        return index.ids, index.ids
    sums = Sums(index, query)
    rows = sums.at_least(sums.kth(k + 1) - sums.slack)  # one more, as the own row may be among them
    rows = rows[index.rows[rows] != row]
    shared = min(len(query), len(index.low))
    values, weights = index.values(rows)[:, :shared], query[:shared]
    if sum(abs(w) * v for w, v in zip(weights.tolist(), index.most())) < 1 << 63:
        scores = values @ weights
        order = np.lexsort((index.ids[rows], -scores))[:k]
        return index.ids[rows[order]], scores[order]
    exact = [sum(a * b for a, b in zip(v, weights.tolist())) for v in values.tolist()]
    best = sorted(zip((-x for x in exact), index.ids[rows].tolist()))[:k]
    if any(abs(x) >= 1 << 63 for x, _ in best):
        raise OverflowError("score beyond 64 bits")
    return np.array([i for _, i in best], np.int64), np.array([-x for x, _ in best], np.int64)


def top_k(vectors: DataFrame, k: int = 10, queries: str = "vec_id % 100 = 0") -> DataFrame:
    """(query_id, rank, vec_id, score): the best ``k`` rows for each row that meets ``queries`` (a condition on vec_id)."""
    data = written(quantised(vectors), "quantised")
    n_blocks = max(1, -(-data.count() // BLOCK_ROWS))
    asked = data.where(queries)
    n_chunks = max(1, -(-asked.count() // CHUNK_QUERIES))

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("row")
        index = Slices.build(pdf["vec_id"].to_numpy(np.int64), _matrix(pdf["q"]), pdf["row"].to_numpy(np.int64))
        parts = [x.tobytes() for x in (index.rows, index.ids, index.low, np.ascontiguousarray(index.bits))]
        names = ["block", "width", "rows", "ids", "low", "bits"]
        return pd.DataFrame([[pdf["block"].iloc[0], index.bits.shape[1], *parts]], columns=names)

    def bundle(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("row")
        matrix = _matrix(pdf["q"])
        parts = [*(pdf[c].to_numpy(np.int64).tobytes() for c in ("row", "vec_id")), matrix.tobytes()]
        return pd.DataFrame([[pdf["chunk"].iloc[0], matrix.shape[1], *parts]], columns=["chunk", "dim", "qrows", "qids", "q"])

    def dealt(n: int, seed: int) -> F.Column:
        return F.pmod(F.xxhash64("row", F.lit(seed)), F.lit(n))

    blocks = written(
        data.withColumn("block", dealt(n_blocks, 1))
        .groupBy("block")
        .applyInPandas(pack, "block long, width int, rows binary, ids binary, low binary, bits binary"),
        "blocks",
    )
    chunks = (
        asked.withColumn("chunk", dealt(n_chunks, 2))
        .groupBy("chunk")
        .applyInPandas(bundle, "chunk long, dim int, qrows binary, qids binary, q binary")
    )
    # Every chunk of the stated query set meets every block. A block is copied to a few lanes, among
    # which the chunks are dealt, so that many tasks share the work on one block.
    lanes = min(n_chunks, LANES)
    pairs = blocks.selectExpr("block AS to_block", f"explode(sequence(0L, {n_chunks - 1}L)) AS chunk")
    asked_of = chunks.join(pairs, "chunk").withColumn("to_lane", F.col("chunk") % lanes)
    copies = blocks.withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))))
    met = asked_of.join(copies, F.expr("to_block = block AND to_lane = lane"))

    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for r in frame.itertuples(index=False):
                ids = np.frombuffer(r.ids, np.int64)
                low = np.frombuffer(r.low, np.int64)
                words = -(-len(ids) // 64)
                index = Slices(np.frombuffer(r.rows, np.int64), ids, low, np.frombuffer(r.bits, "<u8").reshape(len(low), r.width, words))
                found = []
                qrows, qids = np.frombuffer(r.qrows, np.int64), np.frombuffer(r.qids, np.int64)
                asked_here = np.frombuffer(r.q, np.int64).reshape(len(qids), r.dim)
                for row, query_id, query in zip(qrows, qids, asked_here, strict=True):
                    near, scores = search(index, int(row), query, k)
                    found.append(pd.DataFrame({"row": row, "query_id": query_id, "vec_id": near, "score": scores}))
                yield pd.concat(found)

    found = met.select("width", "rows", "ids", "low", "bits", "dim", "qrows", "qids", "q").mapInPandas(
        score, "row long, query_id long, vec_id long, score long"
    )
    best = Window.partitionBy("row").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
