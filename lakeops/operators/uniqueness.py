"""Keys that occur in several rows, found without shuffling the keys.

On a key that is unique, or almost, an aggregate by key sends every key through the shuffle to learn that each
occurs once. Here two passes send far less:

1. A key is hashed to a slot. Tasks sort the slots of their rows and send them as compressed gaps, a slot at most twice
   for each ``CHUNK_KEYS`` rows. They are merged by ranges of slots ("bands"); slots met twice are the candidates. Hot keys
   cost two gaps a chunk, and bands are equal parts of the hash, so no band grows with a hot key.
2. Only keys on candidate slots are counted, exactly. Different keys that share a slot drop out here.

There are so many slots that about ``CHANCE_SLOTS`` of them at most are met twice by chance, at any number of rows (up to 2^41,
from where all 64 bits of the hash are used). So more than ``HELD_SLOTS`` candidates mean as many keys that do repeat:
then the table is far from unique, and all its keys are counted by one aggregate. Up to that number the candidates are
broadcast, at 8 bytes each and some 60 MB at most in an executor's memory. Results are the same on both ways.

The rows are read once to count them, once for the slots and, if there are candidates, once more to count their keys; of
Parquet tables these are the footers' or the key columns' bytes only. The rows must be the same each time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.functions.keys import quote
from lakeops.session import shared_path

CHUNK_KEYS = 1 << 22  # slots that a task sorts at once: 32 MB
BAND_KEYS = 1 << 23  # slots that a merging task holds, on average at most: 64 MB
CHANCE_SLOTS = 1 << 18
HELD_SLOTS = 1 << 20
_SLOT, _PACKED = "__slot", pa.schema([("key", pa.int32()), ("band", pa.int64()), ("slots", pa.int64()), ("gaps", pa.binary())])


def slot_bits(rows: int) -> int:
    """How many bits of the hash make a slot, for a key of so many rows."""
    n = max(1, rows - 1).bit_length()
    return min(64, max(n + 8, 2 * n - (CHANCE_SLOTS.bit_length() - 1)))


def band_bits(rows: int) -> int:
    """How many leading bits of a slot make its band."""
    return max(0, -(-rows // BAND_KEYS) - 1).bit_length()


def pack(slots: np.ndarray, base: int) -> bytes:
    """Ascending slots, none below ``base``, as compressed gaps: byte planes, so that high bytes, mostly zero, cost little."""
    gaps = np.diff(slots, prepend=np.uint64(base))
    width = max(1, (int(gaps.max()).bit_length() + 7) // 8)
    planes = gaps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T
    return bytes([width]) + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpack(packed: bytes, n: int, base: int) -> np.ndarray:
    """The ``n`` slots of `pack`."""
    width = packed[0]
    planes = np.frombuffer(pa.decompress(packed[1:], width * n, codec="zstd", asbytes=True), np.uint8).reshape(width, n)
    gaps = np.zeros((n, 8), np.uint8)
    gaps[:, :width] = planes.T
    return np.cumsum(gaps.view("<u8")[:, 0], dtype=np.uint64) + np.uint64(base)


def at_most_twice(slots: np.ndarray) -> np.ndarray:
    """Sorted slots, each at most twice."""
    keep = np.ones(len(slots), bool)
    keep[2:] = slots[2:] != slots[:-2]
    return slots[keep]


def _shifted(values: np.ndarray, by: int) -> np.ndarray:
    return values >> np.uint64(by) if by < 64 else np.zeros_like(values)


def _packer(bits: Sequence[int], bands: Sequence[int]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The first pass of a task: a column of slots (null: no key) per key in, packed slots by band out."""

    def flush(key: int, held: list[np.ndarray]) -> pa.RecordBatch:
        slots = np.concatenate(held)
        slots.sort()
        slots = at_most_twice(slots)
        by = bits[key] - bands[key]
        band = _shifted(slots, by)
        starts = np.flatnonzero(np.concatenate(([True], band[1:] != band[:-1])))
        ends = np.append(starts[1:], len(slots))
        firsts = band[starts].tolist()
        gaps = [pack(slots[a:b], x << by) for a, b, x in zip(starts.tolist(), ends.tolist(), firsts)]
        columns = [pa.array([key] * len(starts), pa.int32()), pa.array(firsts, pa.int64()), pa.array(ends - starts, pa.int64())]
        return pa.RecordBatch.from_arrays([*columns, pa.array(gaps, pa.binary())], schema=_PACKED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = [[] for _ in bits]
        sizes = [0] * len(bits)
        for batch in batches:
            for key, column in enumerate(batch.columns):
                found = column.drop_null().to_numpy(zero_copy_only=False).view(np.uint64)
                if len(found):
                    held[key].append(found.copy())
                    sizes[key] += len(found)
                if sizes[key] >= CHUNK_KEYS:
                    yield flush(key, held[key])
                    held[key], sizes[key] = [], 0
        for key, rest in enumerate(held):
            if rest:
                yield flush(key, rest)

    return run


def _merger(bits: Sequence[int], bands: Sequence[int]) -> Callable[[pa.Table], pa.Table]:
    """Merges the packed slots of one band; gives those met twice."""

    def run(band: pa.Table) -> pa.Table:
        key = band.column("key")[0].as_py()
        base = band.column("band")[0].as_py() << (bits[key] - bands[key])
        parts = zip(band.column("gaps"), band.column("slots").to_pylist())
        slots = np.concatenate([unpack(gaps.as_py(), n, base) for gaps, n in parts])
        slots.sort()
        met = np.unique(slots[1:][slots[1:] == slots[:-1]]).view(np.int64)
        return pa.table({"key": pa.array(np.full(len(met), key, np.int32)), _SLOT: pa.array(met)})

    return run


def _present(columns: Sequence[str]) -> str:
    return " AND ".join(f"{quote(c)} IS NOT NULL" for c in columns)


def _slot(columns: Sequence[str], bits: int) -> str:
    h = f"xxhash64({', '.join(map(quote, columns))})"
    return f"CASE WHEN {_present(columns)} THEN {f'shiftrightunsigned({h}, {64 - bits})' if bits < 64 else h} END"


def packed_slots(df: DataFrame, keys: Sequence[Sequence[str]], rows: Sequence[int]) -> DataFrame:
    """The first pass before its merge: ``key, band, slots, gaps``, what it sends through the shuffle."""
    bits, bands = [slot_bits(n) for n in rows], [band_bits(n) for n in rows]
    slots = df.selectExpr(*(f"{_slot(cols, b)} AS {_SLOT}{i}" for i, (cols, b) in enumerate(zip(keys, bits))))
    return slots.mapInArrow(_packer(bits, bands), "key int, band long, slots long, gaps binary")


@dataclass(frozen=True)
class Repeats:
    """What the first pass found out about a key."""

    df: DataFrame
    columns: tuple[str, ...]
    rows: int  # rows in which no column of the key is NULL
    candidates: DataFrame | None  # slots; None if they are too many
    found: int  # number of candidates

    def keys(self) -> DataFrame:
        """The key's columns and ``rows``: every key that occurs in more than one row, with how many."""
        named = [quote(c) for c in self.columns]
        kept = self.df.where(_present(self.columns))
        if self.found == 0:
            kept = kept.selectExpr(*named).where("false")
        elif self.candidates is not None:
            slotted = kept.selectExpr(*named, f"{_slot(self.columns, slot_bits(self.rows))} AS {_SLOT}")
            kept = slotted.join(F.broadcast(self.candidates), _SLOT, "left_semi")
        counted = kept.groupBy(*map(F.col, named)).agg(F.count(F.lit(1)).alias("__rows")).where("__rows > 1")
        return counted.selectExpr(*named, "__rows AS rows")


def find_repeats(df: DataFrame, keys: Sequence[Sequence[str]]) -> list[Repeats]:
    """The first pass for several keys (each a list of columns) of one table, in one scan after the count.

    A key with a NULL in any of its columns is no key: its row is left out. Repeated rows repeat their keys. An empty
    table, or a key that is always NULL, has none. Columns of any type but maps will do.
    The candidates are written to the shared folder of ``spark.checkpoint.dir``.
    """
    if any("rows" in cols for cols in keys):
        raise ValueError("rename the key column `rows`: results have a count of that name")
    spark = df.sparkSession
    counts = df.selectExpr(*(f"count_if({_present(cols)}) AS n{i}" for i, cols in enumerate(keys))).first()
    rows = list(counts)
    bits, bands = [slot_bits(n) for n in rows], [band_bits(n) for n in rows]
    place = shared_path(spark, "repeats", unique=True)
    tasks = sum(1 << b for b in bands)  # the merge's work follows the rows
    packed = packed_slots(df, keys, rows).repartition(tasks, "key", "band")
    merged = packed.groupBy("key", "band").applyInArrow(_merger(bits, bands), f"key int, {_SLOT} long")
    merged.write.parquet(place)
    met = spark.read.schema(merged.schema).parquet(place)
    found = {r["key"]: r["count"] for r in met.groupBy("key").count().collect()}  # one row per key given
    out = []
    for i, cols in enumerate(keys):
        n = found.get(i, 0)
        held = met.where(f"key = {i}").select(_SLOT) if n <= HELD_SLOTS else None
        out.append(Repeats(df, tuple(cols), rows[i], held, n))
    return out


def repeated_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns and ``rows``: every key without NULLs that occurs in more than one row, with how many (see `find_repeats`)."""
    return find_repeats(df, [columns])[0].keys()
