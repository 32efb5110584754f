"""Removal of repeated byte strings with longest-previous-factor arrays.

A byte is removed if it is covered by a string of ``least`` (50) bytes that also starts in a document
with a smaller id. Texts are UTF-8 bytes; strings are judged on the input and never cross documents.

One suffix array over a corpus does not exist on a cluster, so equal strings are first brought together:

1. Blocks. Documents are packed into blocks of a few MB, written once to the shared folder; later steps
   read a block's file and move only what they found in it.
2. Meeting points. In each window of 50 bytes the smallest hash of its 20-byte strings (the leftmost of
   equals) is its meeting point. Equal windows have equal meeting points. Consecutive windows that
   share one form a segment of 50 to 80 bytes; every window is in exactly one segment.
3. Shared points. Distinct points of each block (8 bytes each) are shuffled by hash range. A point that
   only one document has cannot be the place of a repeat. The blocks get back their shared points.
4. Segments of shared points, each distinct one once per block with its smallest document, are shuffled
   by point. There, of each group with different segments, a suffix array (in the order of the first 50
   bytes, documents in order of id) is built; the previous and next smaller documents in suffix order
   give the longest previous factors, and a window whose factor reaches 50 bytes has an earlier match.
   For a segment that the group holds once, the factor is the segment itself in its first document.
5. Each block turns the answers into removed spans: a document later than the segment's first one loses
   all of its windows, the first one those that have earlier matches.

Hot points: a passage in very many documents has one entry per block (step 3) and one segment per block
(step 4). Its edges differ in each document; points found in more than ``crowd`` blocks are therefore
cut to single windows, which are dealt by their own hash. Nothing is capped or sampled.

Defined cases: a null text is empty. Rows with a null id take no part and keep everything. Rows with one
id are one document: they never shorten each other. Very long texts are hashed in pieces of bounded
scratch space. Empty tables give empty results. Columns are carried along where asked for.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs, ipc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import new_folder, release, slices, text_bytes, written

LEAST = 50
GRAM = 20
SPAN = LEAST - GRAM + 1  # 20-byte strings in a window
BLOCK_BYTES = 4 << 20
PIECE = 1 << 18
WINDOWS = 1 << 17  # windows that are sorted at once, unless one point has more
BLOCKS_A_TASK = 3
_EVEN = np.uint64(0x9E3779B97F4A7C15)  # odd: points, the least of many hashes, spread over all ranges
PART_POINTS = 1 << 18  # points that one task compares
PART_BYTES = 4 << 20  # bytes of segments that one task sorts
_UPPER = np.uint64(0xFFFFFFFF00000000)
_LOWER = np.uint64(0xFFFFFFFF)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each 20-byte string."""
    base = 0x9E3779B97F4A7C15
    mask = (1 << 64) - 1
    power = {n: np.uint64(pow(base, n, 1 << 64)) for n in (1, 2, 4, 8)}
    h, four, n = data.astype(np.uint64) + np.uint64(1), None, 1
    while n < 16:
        h = h[:-n] * power[n] + h[n:]
        n *= 2
        if n == 4:
            four = h
    h = h[: len(data) - GRAM + 1] * power[4] + four[16 : 16 + len(data) - GRAM + 1]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93 & mask)
    h ^= h >> np.uint64(29)
    return h


def sliding_least(keys: np.ndarray, width: int = SPAN) -> np.ndarray:
    """The least key of each run of ``width`` keys."""
    n, least = 1, keys
    while 2 * n <= width:
        least = np.minimum(least[:-n], least[n:])
        n *= 2
    return np.minimum(least[: len(keys) - width + 1], least[width - n : width - n + len(keys) - width + 1])


def segments(data: np.ndarray, sizes: np.ndarray, part: np.ndarray) -> tuple[np.ndarray, ...]:
    """(start, windows, point, document) of the segments of a block; documents with ``part`` false have none."""
    document = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    ends = np.cumsum(sizes)
    found = []
    for at in range(0, len(data) - LEAST + 1, PIECE):
        piece = data[at : at + PIECE + LEAST - 1]
        hashes = gram_hashes(piece)
        least = sliding_least((hashes & _UPPER) | np.arange(len(hashes), dtype=np.uint64))
        place = (least & _LOWER).astype(np.int64)
        window = np.arange(at, at + len(place))
        owner = document[window]
        valid = (ends[owner] - window >= LEAST) & part[owner]
        new = valid.copy()
        new[1:] &= (place[1:] != place[:-1]) | ~valid[:-1]
        start = np.flatnonzero(new)
        if len(start):
            many = np.add.reduceat(valid.astype(np.int64), start)
            found.append((window[start], many, hashes[place[start]] * _EVEN, owner[start]))
    if not found:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty.astype(np.uint64), empty
    return tuple(map(np.concatenate, zip(*found, strict=True)))


def previous_smaller(values: np.ndarray) -> np.ndarray:
    """For each place the nearest one before it with a smaller value, or -1."""
    found = np.arange(-1, len(values) - 1)
    open_ = np.arange(len(values))
    while len(open_):
        open_ = open_[found[open_] >= 0]
        open_ = open_[values[found[open_]] >= values[open_]]
        found[open_] = found[found[open_]]
    return found


def earlier_matches(windows: np.ndarray, document: np.ndarray) -> np.ndarray:
    """Whether each window (a row of 50 bytes) also occurs in a smaller document.

    Suffix array of the windows, then longest previous factors from the previous and next smaller
    documents in suffix order: the factor reaches 50 bytes if either holds the same 50 bytes.
    """
    n = len(windows)
    padded = np.zeros((n, -(-LEAST // 8) * 8), np.uint8)
    padded[:, :LEAST] = windows
    words = padded.view(">u8").astype(np.uint64)
    suffix = np.lexsort((document, *words.T[::-1]))
    ordered, of = words[suffix], document[suffix]
    run = np.concatenate([[0], np.cumsum((ordered[1:] != ordered[:-1]).any(axis=1))])
    before = previous_smaller(of)
    after = n - 1 - previous_smaller(of[::-1])[::-1]
    reaches = (before >= 0) & (run[before] == run)
    reaches |= (after < n) & (run[np.minimum(after, n - 1)] == run)
    out = np.zeros(n, bool)
    out[suffix] = reaches
    return out


def _opened(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


class Block:
    """The documents of a block, read from its file."""

    def __init__(self, uri: str, doc_id: str, text: str):
        system, place = _opened(uri)
        with system.open_input_file(place) as source:
            self.batch = ipc.open_file(source).get_batch(0)
        self.texts = text_bytes(self.batch.column(text))
        self.sizes = np.fromiter(map(len, self.texts), np.int64, len(self.texts))
        self.data = np.frombuffer(b"".join(self.texts), np.uint8)
        ids = self.batch.column(doc_id)
        self.known = np.array(ids.is_valid().to_pylist(), bool)
        self.ids = np.array(ids.cast(pa.int64()).fill_null(0).to_pylist(), np.int64)

    def segments(self) -> tuple[np.ndarray, ...]:
        return segments(self.data, self.sizes, self.known)


def _save(uri: str, write) -> None:
    """Write a file under another name and move it to its place, so that it is there whole or not at all."""
    system, place = _opened(uri)
    system.create_dir(place.rpartition("/")[0], recursive=True)
    passing = f"{place}.{uuid.uuid4().hex}"
    with system.open_output_stream(passing) as out:
        write(out)
    system.move(passing, place)


def _pack(docs: DataFrame, text: str) -> DataFrame:
    """(block, uri, bytes): the documents in block files."""
    folder = new_folder(docs.sparkSession, "blocks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text, BLOCK_BYTES):
            name = uuid.uuid4()
            uri = f"{folder}/{name.hex}.arrow"
            options = ipc.IpcWriteOptions(compression=pa.Codec("zstd"))

            def write(out, batch=batch, options=options) -> None:
                with ipc.new_file(out, batch.schema, options=options) as writer:
                    writer.write_batch(batch)

            _save(uri, write)
            size = pa.compute.sum(pa.compute.binary_length(batch.column(text))).as_py() or 0
            yield pa.RecordBatch.from_arrays(
                [pa.array([name.int >> 65], pa.int64()), pa.array([uri]), pa.array([size], pa.int64())],
                names=["block", "uri", "bytes"],
            )

    return written(docs.mapInArrow(run, "block long, uri string, bytes long"), "manifest")


def _spread(blocks: DataFrame) -> DataFrame:
    """Block rows over many tasks: the rows are small, the work on each is not."""
    return blocks.repartition(max(1, -(-blocks.count() // BLOCKS_A_TASK)), "block")


def _cuts(points: np.ndarray, parts: int) -> np.ndarray:
    """Where sorted points leave each of ``parts`` equal hash ranges."""
    edges = np.array([(k << 64) // parts for k in range(1, parts)], np.uint64)
    return np.concatenate([[0], np.searchsorted(points, edges), [len(points)]]).astype(np.int64)


def _joined(column: pd.Series, type_: str) -> np.ndarray:
    return np.frombuffer(b"".join(column), type_)


def _shared_points(manifest: DataFrame, doc_id: str, text: str, crowd: int) -> DataFrame:
    """(block, points, hot): of each block the points that two or more documents have, sorted."""
    parts = max(1, -(-(manifest.agg(F.sum("bytes")).first()[0] or 0) // (16 * PART_POINTS)))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, uri in zip(batch.column("block").to_pylist(), batch.column("uri").to_pylist(), strict=True):
                held = Block(uri, doc_id, text)
                _, _, point, owner = held.segments()
                if not len(point):
                    continue
                order = np.argsort(point)
                point, ids = point[order], held.ids[owner[order]]
                first = np.flatnonzero(np.concatenate([[True], point[1:] != point[:-1]]))
                several = np.minimum.reduceat(ids, first) < np.maximum.reduceat(ids, first)
                point = point[first]
                cuts = _cuts(point, parts)
                some = np.flatnonzero(np.diff(cuts))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(some, pa.int64()),
                        pa.array([block] * len(some), pa.int64()),
                        pa.array([point[cuts[k] : cuts[k + 1]].tobytes() for k in some], pa.binary()),
                        pa.array([np.packbits(several[cuts[k] : cuts[k + 1]]).tobytes() for k in some], pa.binary()),
                    ],
                    names=["part", "block", "points", "several"],
                )
                release()

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        sizes = np.array([len(p) // 8 for p in pdf["points"]], np.int64)
        points = _joined(pdf["points"], np.uint64)
        several = np.concatenate(
            [np.unpackbits(np.frombuffer(s, np.uint8), count=n) for s, n in zip(pdf["several"], sizes, strict=True)]
        )
        order = np.argsort(points, kind="stable")
        ordered = points[order]
        first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        many = np.diff(np.concatenate([first, [len(points)]]))
        shared = (many > 1) | (np.add.reduceat(several[order].astype(np.int64), first) > 0)
        mark = np.empty(len(points), np.uint8)
        mark[order] = np.repeat(shared + (shared & (many > crowd)), many)
        rows, at = [], 0
        for block, n in zip(pdf["block"], sizes, strict=True):
            here, of = points[at : at + n], mark[at : at + n]
            if of.any():
                rows.append((block, here[of == 1].tobytes(), here[of == 2].tobytes()))
            at += n
        release()
        return pd.DataFrame(rows, columns=["block", "points", "hot"])

    sent = _spread(manifest).mapInArrow(send, "part long, block long, points binary, several binary")
    return sent.groupBy("part").applyInPandas(compare, "block long, points binary, hot binary")


def _distinct_segments(held: Block, points: np.ndarray, hot: np.ndarray) -> tuple:
    """The hit segments of a block: (start, windows, number) and of each number its bytes, point and document."""
    start, many, point, owner = held.segments()
    hit, crowded = np.isin(point, points), np.isin(point, hot)
    single = np.repeat(np.flatnonzero(crowded), many[crowded])
    step = np.arange(len(single)) - np.repeat(np.cumsum(many[crowded]) - many[crowded], many[crowded])
    start = np.concatenate([start[hit], start[single] + step])
    many = np.concatenate([many[hit], np.ones(len(single), np.int64)])
    whole = int(hit.sum())
    key, owner = point[hit], np.concatenate([owner[hit], owner[single]])
    data = held.data.tobytes()
    numbers: dict[bytes, int] = {}
    ends = start + many + LEAST - 1
    number = np.fromiter(
        (numbers.setdefault(data[a:b], len(numbers)) for a, b in zip(start.tolist(), ends.tolist(), strict=True)),
        np.int64,
        len(start),
    )
    first = np.full(len(numbers), np.iinfo(np.int64).max)
    np.minimum.at(first, number, held.ids[owner])
    texts = list(numbers)
    own = np.zeros(len(numbers), np.uint64)
    lone = np.unique(number[whole:])
    own[number[:whole]] = key
    for i in lone.tolist():
        own[i] = xxhash.xxh64_intdigest(texts[i])
    return start, many, number, texts, own, first


_BUNDLE = pa.schema(
    [("part", pa.int64()), ("block", pa.int64())]
    + [(name, pa.binary()) for name in ("number", "point", "first", "size", "bytes")]
)


def _segment_bundles(marked: DataFrame, parts: int, doc_id: str, text: str) -> DataFrame:
    """Distinct hit segments of each block by part; their places stay beside the block's file."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        small = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for row in batch.to_pylist():
                held = Block(row["uri"], doc_id, text)
                points = np.frombuffer(b"".join(row["points"]), np.uint64)
                hot = np.frombuffer(b"".join(row["hot"]), np.uint64)
                start, many, number, texts, own, first = _distinct_segments(held, points, hot)
                places = np.stack([start, many, number]).astype(np.int64).tobytes()
                _save(row["uri"] + ".places", lambda out, p=places: out.write(small.compress(p)))
                order = np.argsort(own)
                cuts = _cuts(own[order], parts)
                rows = []
                for k in np.flatnonzero(np.diff(cuts)).tolist():
                    mine = order[cuts[k] : cuts[k + 1]]
                    chosen = [texts[i] for i in mine.tolist()]
                    sizes = np.fromiter(map(len, chosen), np.int32, len(chosen))
                    arrays = (mine.astype(np.int32), own[mine], first[mine], sizes)
                    packed = small.compress(b"".join(chosen))
                    rows.append((k, row["block"], *(x.tobytes() for x in arrays), packed))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _BUNDLE.types, strict=True)], schema=_BUNDLE
                )
                release()

    schema = "part long, block long, number binary, point binary, first binary, size binary, bytes binary"
    return marked.select("block", "uri", "points", "hot").mapInArrow(send, schema)


def _earlier_bits(texts: list[bytes], many: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Of each segment, as bits, the windows that a document before its first one has."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = many + LEAST - 1
    owner = np.repeat(np.arange(len(texts)), many)
    step = np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many)
    start = np.repeat(np.cumsum(sizes) - sizes, many) + step
    hits = earlier_matches(np.lib.stride_tricks.sliding_window_view(data, LEAST)[start], first[owner])
    return np.bitwise_or.reduceat(np.where(hits, np.int64(1) << step, 0), np.cumsum(many) - many)


def resolve(pdf: pd.DataFrame) -> pd.DataFrame:
    """(block, number, first, earlier) bundles: of each segment its first document and, as bits, the
    windows that a still earlier document has."""
    unpack = zstandard.ZstdDecompressor()
    numbers: dict[bytes, int] = {}
    which = []
    for sizes, packed in zip(pdf["size"], pdf["bytes"], strict=True):
        data, at = unpack.decompress(packed), 0
        for size in np.frombuffer(sizes, np.int32).tolist():
            which.append(numbers.setdefault(data[at : at + size], len(numbers)))
            at += size
    which = np.array(which, np.int64)
    point = np.zeros(len(numbers), np.uint64)
    point[which] = _joined(pdf["point"], np.uint64)
    first = np.full(len(numbers), np.iinfo(np.int64).max)
    np.minimum.at(first, which, _joined(pdf["first"], np.int64))
    earlier = np.zeros(len(numbers), np.int64)
    _, group, in_group = np.unique(point, return_inverse=True, return_counts=True)
    texts = list(numbers)
    mixed = np.flatnonzero(in_group[group] > 1)
    mixed = mixed[np.argsort(group[mixed], kind="stable")]
    many = np.fromiter((len(texts[i]) - LEAST + 1 for i in mixed.tolist()), np.int64, len(mixed))
    whole = np.flatnonzero(np.diff(group[mixed], append=-1))  # last segment of each point
    bins = np.cumsum(many)[whole] // WINDOWS
    for part in np.split(np.arange(len(mixed)), whole[:-1][np.diff(bins) > 0] + 1):
        if len(part):
            earlier[mixed[part]] = _earlier_bits([texts[i] for i in mixed[part].tolist()], many[part], first[mixed[part]])
    counts = [len(n) // 4 for n in pdf["number"]]
    rows, at = [], 0
    for block, number, n in zip(pdf["block"], pdf["number"], counts, strict=True):
        mine = which[at : at + n]
        rows.append((block, number, first[mine].tobytes(), earlier[mine].astype(np.uint32).tobytes()))
        at += n
    release()
    return pd.DataFrame(rows, columns=["block", "number", "first", "earlier"])


def _removed(held: Block, row: dict) -> np.ndarray:
    """Which bytes of a block go."""
    edge = np.zeros(len(held.data) + 1, np.int32)
    if row["number"]:
        system, place = _opened(row["uri"] + ".places")
        with system.open_input_stream(place) as source:
            places = zstandard.ZstdDecompressor().decompress(source.read())
        start, many, number = np.frombuffer(places, np.int64).reshape(3, -1)
        answer = np.frombuffer(b"".join(row["number"]), np.int32)
        n = int(number.max()) + 1
        first, earlier = np.full(n, np.iinfo(np.int64).max), np.zeros(n, np.int64)
        first[answer] = np.frombuffer(b"".join(row["first"]), np.int64)
        earlier[answer] = np.frombuffer(b"".join(row["earlier"]), np.uint32)
        document = np.repeat(np.arange(len(held.sizes), dtype=np.int32), held.sizes)
        later = held.ids[document[start]] > first[number]
        np.add.at(edge, start[later], 1)
        np.add.at(edge, start[later] + many[later] + LEAST - 1, -1)
        some = np.flatnonzero(~later & (earlier[number] > 0))
        for k in range(SPAN):
            at = start[some[earlier[number[some]] >> k & 1 == 1]] + k
            np.add.at(edge, at, 1)
            np.add.at(edge, at + LEAST, -1)
    return np.cumsum(edge[:-1], dtype=np.int32) > 0


def _answers(docs: DataFrame, doc_id: str, text: str, crowd: int) -> DataFrame:
    """(block, uri, number, first, earlier) per block."""
    manifest = _pack(docs, text)
    points = written(_shared_points(manifest, doc_id, text, crowd), "points")
    size = points.agg(F.sum(F.length("points") + 8 * F.length("hot"))).first()[0] or 0
    parts = max(1, -(-size * 9 // PART_BYTES))  # a point has 8 bytes, its segment about 66
    mine = points.groupBy("block").agg(F.collect_list("points").alias("points"), F.collect_list("hot").alias("hot"))
    # what a block gets is sized by the files it is made of, too low where points repeat: merged, not broadcast
    marked = written(mine.hint("merge").join(manifest, "block"), "marked")
    bundles = _segment_bundles(_spread(marked), parts, doc_id, text)
    resolved = bundles.groupBy("part").applyInPandas(
        resolve, "block long, number binary, first binary, earlier binary"
    )
    # three lists in one order
    answers = (
        resolved.groupBy("block")
        .agg(F.collect_list(F.struct("number", "first", "earlier")).alias("a"))
        .selectExpr("block AS b", "a.number AS number", "a.first AS first", "a.earlier AS earlier")
    )
    joined = manifest.join(answers.hint("merge"), F.col("block") == F.col("b"), "left")
    return _spread(written(joined.select("block", "uri", "number", "first", "earlier"), "answers"))


_KEPT = {
    "kept": ("binary", lambda rest: rest),
    "kept_text": ("string", lambda rest: rest.decode("utf-8", "ignore")),
    "kept_sha256": ("string", lambda rest: sha256(rest).hexdigest()),
}


def remove_repeats(
    docs: DataFrame,
    carry: list[str],
    text: str = "text",
    doc_id: str = "doc_id",
    kept: str = "kept",
    crowd: int = 64,
) -> DataFrame:
    """The ``carry`` columns, n_bytes, n_removed, n_spans and, of the bytes that stay, what ``kept`` names:
    kept (binary), kept_text (characters that were cut in two are left out) or kept_sha256 (lowercase hex).
    These win over a carried column of their name."""
    kind, of = _KEPT[kept]
    carry = [c for c in carry if c not in ("n_bytes", "n_removed", "n_spans", kept)]
    need = list(dict.fromkeys([*carry, doc_id, text]))
    answers = _answers(docs.select(*need), doc_id, text, crowd)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                held = Block(row["uri"], doc_id, text)
                gone = _removed(held, row)
                counts, rests = [], []
                ends = np.cumsum(held.sizes)
                for a, b in zip((ends - held.sizes).tolist(), ends.tolist(), strict=True):
                    mask = gone[a:b]
                    spans = int(mask[:1].sum() + (mask[1:] & ~mask[:-1]).sum())
                    counts.append((b - a, int(mask.sum()), spans))
                    rest = held.data[a:b][~mask].tobytes() if spans else held.data[a:b].tobytes()
                    rests.append(of(rest))
                columns = [held.batch.column(c) for c in carry]
                columns += [pa.array(c, pa.int64()) for c in zip(*counts, strict=True)]
                columns.append(pa.array(rests, pa.binary() if kind == "binary" else pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=[*carry, "n_bytes", "n_removed", "n_spans", kept])
                release()

    types = dict(docs.dtypes)
    added = f"n_bytes long, n_removed long, n_spans long, {kept} {kind}"
    return answers.mapInArrow(run, ", ".join([*(f"`{c}` {types[c]}" for c in carry), added]))


def without_repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with all columns, the texts without their repeats; a column n_chars is set to the new lengths."""
    names = docs.columns
    plain = docs.toDF(*(f"c{i}" for i in range(len(names))))  # no clash with any name used here
    at = names.index(text)
    others = [f"c{i}" for i in range(len(names)) if i != at]
    found = remove_repeats(plain, others, f"c{at}", f"c{names.index(doc_id)}", kept="kept_text")
    columns = []
    for i, name in enumerate(names):
        column = F.col("kept_text") if i == at else F.col(f"c{i}")
        if name == "n_chars":
            column = F.length("kept_text").cast(docs.schema[i].dataType)
        columns.append(column.alias(name))
    return found.select(*columns)
