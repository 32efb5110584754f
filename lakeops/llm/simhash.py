"""SimHash near-duplicates by anchor-point covering.

A fingerprint is 64 bits: bit b is set if more than half of the text's shingle hashes have it.
Fingerprints link at ``distance`` (2) or fewer differing bits.

Covering: the anchors are the words of a covering code, a direct sum of perfect codes over blocks
of the 64 bits (Golay [23,12] with radius 3, Hamming [15,11] with radius 1; bits in no block are
free). Every fingerprint has one home, the anchor nearest to it in each block. If y differs from x
in e_i bits of block i, then x's home lies within radius_i + e_i of y there. So each fingerprint is
replicated to every anchor within the covering radius plus its share of the distance, over all
shares that add up to the distance: two linked fingerprints always meet at the home of either.
Per anchor the homes are compared with the replicas.

The code is chosen by the number of distinct fingerprints: two Golay blocks (2^24 anchors, about 60
replicas) up to 2^24 of them, beyond that a Hamming block more (2^35 anchors, about 170).

Hot anchors: where more than ``crowd`` different fingerprints are at home at one anchor (families of
near copies), comparing them would emit all pairs. They get the finest code instead, whose anchors
are all 64-bit words: two fingerprints at distance 2 or less have a common word at distance 1 or
less from both. An anchor of that code has at most 65 different fingerprints, and its links are
given as a star. Nothing is capped: every link between different fingerprints either is found as
such or lies inside a star of links.

Repeated fingerprints are one row from the start (with their smallest doc_id), however many
documents share them; only fingerprints with a link enter the search for components.

Joins: Spark sizes the replicas like the fingerprints they are made of, some 60 times too low, and tables of
a row per document by their files, where repeated values take little room. Such sides are merged at every
size, never broadcast.

Defined cases: a null or empty text has no words and fingerprint zero, linked like any other. Texts
are hashed whole. Rows with a null doc_id get a fingerprint, and the component of the documents
within reach, but do not name one: alone, their component is null. Repeated rows get equal results.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices, text_bytes, written
from .components import components

SEED = 42
GOLAY, HAMMING = "golay", "hamming"
#: Generator polynomials: length, check bits, polynomial, covering radius. (Fixed values.)
CODES = {GOLAY: (23, 11, 0b101011100011, 3), HAMMING: (15, 4, 0b10011, 1)}


def shingle_hashes(text: bytes, length: int = 3) -> list[int]:
    """XXH64 of each run of ``length`` words of the text, A-Z lower-cased, repeats included."""
    words = text.lower().split()
    if not words:
        return []
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= length:
        return [digest(joined, SEED)]
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes)[: len(words) - length + 1].tolist()
    return [digest(joined[a:b], SEED) for a, b in zip(starts, ends[length - 1 :].tolist(), strict=True)]


def fingerprint(text: bytes, length: int = 3) -> int:
    """The fingerprint of a text, as a signed 64-bit integer."""
    hashes = np.array(shingle_hashes(text, length), "<u8")
    if not len(hashes):
        return 0
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 14):  # bounded scratch space for very long texts
        part = hashes[at : at + (1 << 14)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", length: int = 3) -> DataFrame:
    """(doc_id, fp) per row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text, 8 << 20):
            found = [fingerprint(t, length) for t in text_bytes(batch.column(text))]
            yield pa.RecordBatch.from_arrays([batch.column(doc_id), pa.array(found, pa.int64())], names=["doc_id", "fp"])

    return docs.select(doc_id, text).mapInArrow(run, f"doc_id {dict(docs.dtypes)[doc_id]}, fp long")


@lru_cache(maxsize=8)
def _near(code: str, extra: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """By syndrome: which bit patterns of weight radius + extra or less lead from a word to an anchor.

    Returns the patterns in syndrome order, their cost (weight beyond the radius, 0 at least), the
    offsets of each syndrome's patterns, and the syndrome of each single bit.
    """
    length, check, polynomial, radius = CODES[code]
    of_bit = np.zeros(length, np.int64)
    for i in range(length):
        rest = 1 << i
        for shift in range(length - 1, check - 1, -1):
            if rest >> shift & 1:
                rest ^= polynomial << (shift - check)
        of_bit[i] = rest
    patterns, syndromes, costs = [], [], []
    for weight in range(radius + extra + 1):
        chosen = np.array(list(combinations(range(length), weight)), np.int64).reshape(comb(length, weight), weight)
        patterns.append((np.int64(1) << chosen).sum(axis=1))
        syndromes.append(np.bitwise_xor.reduce(of_bit[chosen], axis=1) if weight else np.zeros(1, np.int64))
        costs.append(np.full(len(chosen), max(0, weight - radius)))
    pattern, syndrome, cost = map(np.concatenate, (patterns, syndromes, costs))
    order = np.lexsort((cost, syndrome))
    offsets = np.concatenate([[0], np.cumsum(np.bincount(syndrome, minlength=1 << check))])
    return pattern[order], cost[order], offsets, of_bit


def _syndromes(word: np.ndarray, of_bit: np.ndarray) -> np.ndarray:
    found = np.zeros(len(word), np.int64)
    for i, s in enumerate(of_bit.tolist()):
        found ^= (word >> i & 1) * s
    return found


def replicas(fp: np.ndarray, code: tuple[str, ...], distance: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, anchor) of every anchor that each fingerprint goes to; at distance 0, its home alone."""
    row = np.arange(len(fp))
    anchor = np.zeros(len(fp), np.int64)
    spent = np.zeros(len(fp), np.int64)
    bits, at = fp.view(np.uint64), 0
    for block in code:
        length, check, _, _ = CODES[block]
        pattern, cost, offsets, of_bit = _near(block, distance)
        word = (bits >> np.uint64(at) & np.uint64((1 << length) - 1)).astype(np.int64)
        syndrome = _syndromes(word, of_bit)[row]
        many = offsets[syndrome + 1] - offsets[syndrome]
        grown = np.repeat(np.arange(len(row)), many)
        step = np.arange(len(grown)) - np.repeat(np.cumsum(many) - many, many)
        pick = offsets[syndrome][grown] + step
        total = spent[grown] + cost[pick]
        keep = total <= distance
        grown, pick, spent = grown[keep], pick[keep], total[keep]
        near = word[row[grown]] ^ pattern[pick]
        row = row[grown]
        anchor = anchor[grown] << (length - check) | near >> check  # a code word is known by its upper bits
        at += length
    return row, anchor


def _code_for(n: int) -> tuple[str, ...]:
    return (GOLAY, GOLAY) if n <= 1 << 24 else (GOLAY, GOLAY, HAMMING)


def links(fps: DataFrame, distance: int = 2, crowd: int = 16) -> DataFrame:
    """(a, b): links of the distinct fingerprints ``fp``; see the module text for stars."""
    if distance != 2:
        raise ValueError("the stars of the finest code join what differs in 2 bits or fewer")
    code = _code_for(fps.count())

    def replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("fp").to_numpy()
            for start in range(0, len(values), 4096):
                fp = values[start : start + 4096]
                row, anchor = replicas(fp, code, distance)
                yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(fp[row])], names=["anchor", "fp"])

    def at_home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column("fp").to_numpy()
            row, anchor = replicas(fp, code, 0)
            yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(fp[row])], names=["anchor", "fp"])

    everywhere = fps.mapInArrow(replicate, "anchor long, fp long").hint("merge")
    homes = fps.mapInArrow(at_home, "anchor long, fp long").hint("merge")
    counts = homes.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"))
    # a crowded anchor stands as one row with a null fingerprint
    marked = (
        homes.join(counts, "anchor")
        .selectExpr("anchor", f"CASE WHEN n <= {crowd} THEN fp END AS other")
        .distinct()
    )
    near = f"r.fp <> h.other AND bit_count(r.fp ^ h.other) <= {distance}"
    met = (
        everywhere.alias("r")
        .join(marked.alias("h"), F.expr(f"r.anchor = h.anchor AND (h.other IS NULL OR {near})"))
        .selectExpr("r.fp AS a", "h.other AS b")
        .distinct()
    )
    met = written(met, "met")
    crowded = met.where("b IS NULL").select("a").distinct()
    reach = "concat(array(0L), transform(sequence(0, 63), i -> shiftleft(1L, i)))"
    words = crowded.selectExpr("a", f"explode(transform({reach}, m -> a ^ m)) AS word")
    stars = (
        words.groupBy("word")
        .agg(F.collect_list("a").alias("members"))  # 65 different ones at most
        .where("size(members) > 1")
        .selectExpr("array_min(members) AS a", "explode(members) AS b")
        .where("a < b")
    )
    return met.where("b IS NOT NULL").union(stars)


def _components(rows: DataFrame, distance: int) -> DataFrame:
    """(f, root, component_id) of each distinct fingerprint of (doc_id, fp) rows; roots tell components apart."""
    distinct = written(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    found = components(links(distinct.select("fp"), distance))
    rooted = distinct.join(found, distinct["fp"] == found["node"], "left").selectExpr(
        "fp", "first", "coalesce(root, fp) AS root"
    )
    named = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return rooted.hint("merge").join(named, "root").selectExpr("fp AS f", "root", "component_id")


def near_duplicates(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", length: int = 3, distance: int = 2
) -> DataFrame:
    """(doc_id, fingerprint, component_id) per row of ``docs``.

    fingerprint: 16 lowercase hex digits. component_id: the smallest doc_id that links reach.
    """
    rows = written(fingerprints(docs, text, doc_id, length), "fingerprints")
    per_fp = _components(rows, distance)
    return rows.hint("merge").join(per_fp, rows["fp"] == per_fp["f"]).selectExpr(
        "doc_id", "lower(lpad(hex(fp), 16, '0')) AS fingerprint", "component_id"
    )


def without_near_duplicates(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", length: int = 3, distance: int = 2
) -> DataFrame:
    """The rows of ``docs`` that stay when one document of each component does, the first by doc_id.

    A component's rows of that doc_id have equal or near texts: of several, the one with the smallest hash
    of the row stays. Different texts under one doc_id are judged by their own components. Rows with a null
    doc_id stay.
    """
    known = docs.where(F.col(doc_id).isNotNull())
    rows = written(fingerprints(known, text, doc_id, length), "fingerprints")
    per_fp = _components(rows, distance)
    judged = rows.hint("merge").join(per_fp, rows["fp"] == per_fp["f"]).select("doc_id", "fp", "root", "component_id")
    heads = written(judged.where("doc_id = component_id").distinct(), "heads").hint("merge")
    per_id = rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    single = heads.join(per_id.where("n = 1"), "doc_id").select("doc_id")
    alone = docs.alias("d").join(single.alias("s"), F.col(f"d.{doc_id}") == F.col("s.doc_id"), "left_semi")
    # texts of repeated ids are told apart by their fingerprints
    several = docs.alias("d").join(
        per_id.where("n > 1").alias("s"), F.col(f"d.{doc_id}") == F.col("s.doc_id"), "left_semi"
    )

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "t", 8 << 20):
            found = [fingerprint(t, length) for t in text_bytes(batch.column("t"))]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(found, pa.int64())], names=["row", "fp"])

    packed = several.select(F.struct("d.*").alias("row"), F.col(f"d.{text}").alias("t"))
    schema = T.StructType([packed.schema["row"], T.StructField("fp", T.LongType())])
    marked = packed.mapInArrow(told, schema).alias("p")
    same = (F.col(f"p.row.`{doc_id}`") == F.col("h.doc_id")) & (F.col("p.fp") == F.col("h.fp"))
    chosen = (
        marked.join(heads.alias("h"), same)
        .groupBy("h.doc_id", "h.root")
        .agg(F.min_by("p.row", F.xxhash64("p.row")).alias("row"))
        .select(*(F.col(f"row.`{c}`").alias(c) for c in docs.columns))
    )
    return alone.unionByName(chosen).unionByName(docs.where(F.col(doc_id).isNull()))
