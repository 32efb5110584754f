"""A large JSON array of objects, read by several tasks.

Brackets tell where an object ends only outside strings, and whether a byte lies in a string depends on all
quotes before it. So the file is read in two passes over blocks of bytes:

1. Each block reports, for each state in which it may begin (outside a string, inside one, inside one after
   a backslash), the state in which it ends and how much deeper its brackets lead. A prefix scan over
   these few numbers per block, by file, gives the state and depth in which each block really begins.
2. Each block cuts out the objects that begin in it, reading on past its end where one goes on.
   Their texts are parsed by Spark's ``from_json``.

Both passes work on the same list of blocks, so tasks that run again give the same rows. Files are listed by Spark and
read through Arrow's file systems, by URI.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as fs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.session import shared_path
from lakeops.sources.files import SEO_RANKINGS_SCHEMA, _missing

BLOCK_BYTES = 8 << 20
BLOCKS_A_TASK = 4
TASK_BYTES = BLOCKS_A_TASK * BLOCK_BYTES  # of blocks of any size
OUTSIDE, INSIDE, ESCAPED = 0, 1, 2  # states: of a string, and after a backslash in one
_QUOTE, _BACKSLASH = 34, 92
_STEP = np.zeros(256, np.int8)
_STEP[[ord("["), ord("{")]] = 1
_STEP[[ord("]"), ord("}")]] = -1
_MARK = _STEP != 0
_MARK[_QUOTE] = True
_BETWEEN = b" \t\r\n,"
_IS_BETWEEN = np.zeros(256, bool)
_IS_BETWEEN[list(_BETWEEN)] = True


def _escaped(data: np.ndarray, state: int) -> np.ndarray:
    """Places behind an odd number of backslashes, ascending; the last may be that behind the data."""
    slashes = np.flatnonzero(data == _BACKSLASH)
    ends = np.flatnonzero(np.diff(slashes, append=len(data) + 1) != 1)  # the last backslash of each run
    lengths = np.diff(ends, prepend=-1)
    behind = slashes[ends] + 1
    if state == ESCAPED:  # a backslash before the data
        if len(slashes) and slashes[0] == 0:
            lengths[0] += 1
        else:
            behind, lengths = np.append(0, behind), np.append(1, lengths)
    return behind[lengths % 2 == 1]


def _marks(data: np.ndarray, state: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Places of quotes and brackets; +1 or -1 for each that is a bracket outside strings, else 0; and the state at the end."""
    places = np.flatnonzero(_MARK[data])
    kinds = data[places]
    quotes = kinds == _QUOTE
    escaped = _escaped(data, state)
    if len(escaped):
        at = np.searchsorted(places, escaped)
        there = at < len(places)
        at, escaped_places = at[there], escaped[there]
        quotes[at[places[at] == escaped_places]] = False
    count = np.cumsum(quotes, dtype=np.int32) + np.int32(state != OUTSIDE)  # odd: inside a string
    inside = (int(count[-1]) if len(count) else int(state != OUTSIDE)) % 2 == 1
    end = OUTSIDE if not inside else ESCAPED if len(escaped) and escaped[-1] == len(data) else INSIDE
    return places, np.where(count % 2 == 0, _STEP[kinds], np.int8(0)), end


def effect(data: bytes) -> list[tuple[int, int]]:
    """(state at the end, change of depth) of a block for each state in which it may begin."""
    view = np.frombuffer(data, np.uint8)
    found = [(end, int(steps.sum(dtype=np.int64))) for _, steps, end in (_marks(view, s) for s in (OUTSIDE, INSIDE))]
    if data[:1] in (b"", b"\\", b'"'):
        _, steps, end = _marks(view, ESCAPED)
        return [*found, (end, int(steps.sum(dtype=np.int64)))]
    return [*found, found[INSIDE]]  # what a backslash before the block escapes is neither a quote nor a backslash


def objects(data: bytes, state: int, depth: int, own: int) -> tuple[list[bytes], bool]:
    """The objects that begin in the first ``own`` bytes, and whether ``data`` holds the last of them whole.

    ``depth`` is that at the beginning: 0 before the array or after it, 1 between its objects, more inside one.
    """
    view = np.frombuffer(data, np.uint8)
    places, steps, _ = _marks(view, state)
    levels = np.cumsum(steps, dtype=np.int32) + np.int32(depth)
    starts = places[(steps == 1) & (levels == 2)]
    ends = places[(steps == -1) & (levels == 1)] + 1
    first = 0
    if depth > 1:  # in an object of an earlier block
        if not len(ends):
            return [], True
        first, ends = int(ends[0]), ends[1:]
    mine = int(np.searchsorted(starts, own))
    whole = len(ends) >= mine
    a, b = starts[:mine], ends[:mine]
    a = a[: len(b)]
    if (view[a] != ord("{")).any():
        raise ValueError("JSON array holds an element that is no object")
    before = np.append(first, b[:-1])[: len(a)]  # where the text between two objects begins
    plain = (a - before == 1) & _IS_BETWEEN[view[before]]
    for x, y in zip(before[~plain].tolist(), a[~plain].tolist()):
        _check(data[x:y], b"[" if x == 0 and depth == 0 else b"")
    found = [data[x:y] for x, y in zip(a.tolist(), b.tolist())]
    at = int(b[-1]) if len(found) else first
    if whole:
        rest = int(starts[mine]) if mine < len(starts) else len(data)
        left = data[at : min(rest, max(own, at))]
        _check(left, b"[]")
    return found, whole


def _check(text: bytes, marks: bytes) -> None:
    if text.strip(_BETWEEN + marks + b"\xef\xbb\xbf"):
        raise ValueError("JSON array holds an element that is no object")


def _read(uri: str, start: int, length: int) -> bytes:
    system, place = fs.FileSystem.from_uri(uri)
    with system.open_input_file(place) as source:
        return source.read_at(length, start)


def _blocks(spark: SparkSession, path: str, block_bytes: int) -> DataFrame:
    """(file, bytes, block) of the files at ``path``, a file, folder or glob."""
    try:
        listed = spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), F.col("length").alias("bytes"))
    except AnalysisException as e:
        if _missing(e):
            raise FileNotFoundError(f"JSON input not found at {path}") from e
        raise
    last = F.floor((F.greatest(F.col("bytes"), F.lit(1)) - 1) / F.lit(block_bytes)).cast("long")
    return listed.select("file", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("block"))


def _begins(scanned: pd.DataFrame) -> pd.DataFrame:
    """Prefix scan over the blocks of a file: the state and depth in which each begins; the last one must close the array."""
    scanned = scanned.sort_values("block")
    state, depth, opened, states, depths = OUTSIDE, 0, False, [], []
    for row in scanned.itertuples(index=False):
        states.append(state)
        depths.append(depth)
        state, change = row.ends[state], row.changes[state]
        depth += change
        opened = opened or bool(row.opens)
    if depth or state != OUTSIDE or not opened:
        raise ValueError(f"JSON array in {scanned['file'].iloc[0]} is not complete")
    return scanned.assign(state=states, depth=depths)[["file", "bytes", "block", "state", "depth"]]


def read_json_array_split(
    spark: SparkSession, path: str, schema: T.StructType = SEO_RANKINGS_SCHEMA, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """Rows of files that each hold one JSON array of objects, a file being read by several tasks.

    An object that does not fit ``schema``, an element that is no object, or an array that is not closed fails the
    job. Fields that ``schema`` does not name are left out, and those that an object lacks are NULL. An empty array has no
    rows, nor has a file of no bytes, which Spark does not list. A missing ``path`` raises ``FileNotFoundError``. An object lies in the memory of one task.
    """
    if block_bytes < 1:
        raise ValueError("block_bytes must be positive")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            for row in rows:
                start = row["block"] * block_bytes
                data = _read(row["file"], start, min(block_bytes, row["bytes"] - start))
                row["ends"], row["changes"] = (list(x) for x in zip(*effect(data)))
                row["opens"] = row["block"] == 0 and data.strip(_BETWEEN + b"\xef\xbb\xbf")[:1] == b"["
            yield pa.RecordBatch.from_pylist(rows, schema=_SCANNED)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                start = row["block"] * block_bytes
                own, length = min(block_bytes, row["bytes"] - start), 0
                whole, more = False, block_bytes
                while not whole:  # an object that goes on past the block: read on, twice as far each time
                    if length == row["bytes"] - start and length:
                        raise ValueError(f"JSON array in {row['file']} is not complete")
                    length = min(max(length, own) + (more if length else 0), row["bytes"] - start)
                    more *= 2
                    found, whole = objects(_read(row["file"], start, length), row["state"], row["depth"], own)
                for i in range(0, len(found), 10_000):
                    yield pa.RecordBatch.from_arrays([pa.array(found[i : i + 10_000], pa.binary())], names=["text"])

    blocks = _blocks(spark, path, block_bytes)
    place = shared_path(spark, "json_array", unique=True)
    blocks.write.parquet(f"{place}/blocks")
    blocks = spark.read.schema(blocks.schema).parquet(f"{place}/blocks")
    listed, held = blocks.selectExpr("count(1)", f"sum(least(bytes - block * {block_bytes}, {block_bytes}))").first()
    most = -(-listed // BLOCKS_A_TASK)  # the rows are small, the work on each is not
    tasks = max(1, min(most, 4 * spark.sparkContext.defaultParallelism), -(-(held or 0) // TASK_BYTES))
    scanned = blocks.repartition(tasks, "file", "block").mapInArrow(
        scan, "file string, bytes long, block long, ends array<int>, changes array<long>, opens boolean"
    )
    begins = scanned.groupBy("file").applyInPandas(_begins, "file string, bytes long, block long, state int, depth long")
    begins.write.parquet(f"{place}/begins")
    begins = spark.read.schema(begins.schema).parquet(f"{place}/begins")
    texts = begins.repartition(tasks, "file", "block").mapInArrow(cut, "text binary")
    parsed = F.from_json(F.col("text").cast("string"), schema, {"mode": "FAILFAST"})
    return texts.select(parsed.alias("row")).select("row.*")


_SCANNED = pa.schema(
    [("file", pa.string()), ("bytes", pa.int64()), ("block", pa.int64()), ("ends", pa.list_(pa.int32()))]
    + [("changes", pa.list_(pa.int64())), ("opens", pa.bool_())]
)
