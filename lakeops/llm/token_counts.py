"""Token counts of flat token files by separator scan.

A flat token file is a run of unsigned little-endian integers of fixed width; every document ends
with the end-of-document id, and nothing says where documents start. The files are cut into blocks
of fixed size that tasks read by byte range. In a block the separators are found with one vectorised
comparison, which gives the lengths of the documents inside, the tokens before the first separator
and those after the last. A prefix scan over the blocks of each file stitches the boundaries: a
running sum of separators numbers the documents, and a segmented running sum carries the open tokens
of earlier blocks to the block that ends their document.

Files are read and written through Arrow's file systems, by the URI of the folder, so the folder has
to be one that all executors share (``spark.checkpoint.dir``).

Defined cases: an empty document (two separators in a row, or a null text when files are written)
has 0 tokens. Tokens after a file's last separator are one more document. An empty file has none. A
file whose size is not a multiple of the width is refused. Null ids are kept. Repeated rows are documents
of their own. A text of any length is one document, whose tokens may fill many blocks; bytes that are not
UTF-8 are read as U+FFFD. Empty tables give empty results. Other columns are not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import ExitStack

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import tokenizer
from .common import new_folder, slices, texts, written

BLOCK_BYTES = 4 << 20
BLOCKS_A_TASK = 4


def _opened(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def write_token_files(
    docs: DataFrame, path: str, pattern: str, separator: int, width: int = 2, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """Encode documents into flat token files, one per task.

    Returns the manifest (file, bytes, ordinal, doc_id): a row with null ordinal per file and a row
    per document in file order. A task that is run again writes a file of another name; the manifest
    names only the files of tasks that ended well.
    """
    folder = new_folder(docs.sparkSession, "tokens")
    type_ = f"<u{width}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer(path, pattern)
        if separator in t.tokens or separator >= 1 << 8 * width:
            raise ValueError("the separator has to be an id that no token has and that fits the width")
        end = np.array([separator], type_).tobytes()
        uri, ordinal, size = f"{folder}/{uuid.uuid4().hex}.bin", 0, 0
        with ExitStack() as stack:
            out = None
            for batch in slices(batches, text, 12 << 20):
                if out is None:
                    system, place = _opened(uri)
                    system.create_dir(place.rpartition("/")[0], recursive=True)
                    out = stack.enter_context(system.open_output_stream(place))
                for ids in t.encode(texts(batch.column(text))):
                    size += out.write(np.frombuffer(ids, "<u4").astype(type_).tobytes() + end)
                n = batch.num_rows
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([uri] * n),
                        pa.nulls(n, pa.int64()),
                        pa.array(range(ordinal, ordinal + n), pa.int64()),
                        batch.column(doc_id),
                    ],
                    names=["file", "bytes", "ordinal", "doc_id"],
                )
                ordinal += n
        t.forget()
        if ordinal:
            one = batch.column(doc_id).type
            yield pa.RecordBatch.from_arrays(
                [pa.array([uri]), pa.array([size], pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, one)],
                names=["file", "bytes", "ordinal", "doc_id"],
            )

    schema = f"file string, bytes long, ordinal long, doc_id {dict(docs.dtypes)[doc_id]}"
    return written(docs.select(doc_id, text).mapInArrow(run, schema), "manifest")


def scan_block(tokens: np.ndarray, separator: int) -> tuple[int, int, int, np.ndarray]:
    """Separators, tokens before the first, tokens after the last, and lengths between them."""
    at = np.flatnonzero(tokens == separator)
    if not len(at):
        return 0, len(tokens), len(tokens), at
    return len(at), int(at[0]), len(tokens) - int(at[-1]) - 1, np.diff(at) - 1


def count_tokens(files: DataFrame, separator: int, width: int = 2, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(file, ordinal, n_tokens) for the documents of the flat token files (file, bytes)."""
    if block_bytes % width:
        raise ValueError("blocks have to hold whole tokens")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for uri, size, block in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if size % width:
                    raise ValueError(f"{uri} does not hold whole tokens")
                system, place = _opened(uri)
                with system.open_input_file(place) as source:
                    data = source.read_at(min(block_bytes, size - block * block_bytes), block * block_bytes)
                n, head, tail, inner = scan_block(np.frombuffer(data, f"<u{width}"), separator)
                found.append({"file": uri, "block": block, "n_sep": n, "head": head, "tail": tail, "inner": inner})
            yield pa.RecordBatch.from_pylist(found, schema=_SCAN)

    last = F.floor((F.col("bytes") - 1) / F.lit(block_bytes)).cast("long")
    blocks = files.where("bytes > 0").select("file", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("block"))
    blocks = written(blocks, "blocks")
    # the rows are small, the work on each is not
    spread = blocks.repartition(max(1, -(-blocks.count() // BLOCKS_A_TASK)), "file", "block")
    scanned = spread.select("file", "bytes", "block").mapInArrow(
        run, "file string, block long, n_sep long, head long, tail long, inner array<long>"
    )
    scanned = written(scanned, "scanned")
    # only four values of a block pass through the one task of its file; the lengths stay where they are
    order = Window.partitionBy("file").orderBy("block")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    stitched = (
        scanned.select("file", "block", "n_sep", "tail")
        .withColumn("first", F.coalesce(F.sum("n_sep").over(earlier), zero))
        .withColumn("run", F.coalesce(F.sum("tail").over(earlier), zero))
        .withColumn("since", F.last(F.when(F.col("n_sep") > 0, F.col("run")), ignorenulls=True).over(earlier))
        .withColumn("carry", F.col("run") - F.coalesce("since", zero))
        .withColumn("end", F.lead("block").over(order).isNull())
        .select("file", "block", "first", "carry", "end")
    )
    found = scanned.join(stitched.hint("merge"), ["file", "block"])
    closed = F.concat(F.array(F.col("carry") + F.col("head")), F.col("inner"))
    rest = F.col("tail") + F.when(F.col("n_sep") == 0, F.col("carry")).otherwise(zero)
    ended = F.when(F.col("n_sep") > 0, closed).otherwise(F.array().cast("array<bigint>"))
    all_ = F.when(F.col("end") & (rest > 0), F.concat(ended, F.array(rest))).otherwise(ended)
    return found.select("file", "first", F.posexplode(all_).alias("place", "n_tokens")).select(
        "file", (F.col("first") + F.col("place")).alias("ordinal"), "n_tokens"
    )


_SCAN = pa.schema(
    [("file", pa.string()), ("block", pa.int64()), ("n_sep", pa.int64()), ("head", pa.int64()), ("tail", pa.int64())]
    + [("inner", pa.list_(pa.int64()))]
)


def document_tokens(manifest: DataFrame, separator: int, width: int = 2, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, n_tokens) of the documents that `write_token_files` wrote.

    The manifest's repeated file names compress so well that its size on disk says little about its
    size in memory; the join is merged, as it could be broadcast by that estimate.
    """
    files = manifest.where("ordinal IS NULL").select("file", "bytes")
    counted = count_tokens(files, separator, width, block_bytes)
    documents = manifest.where("ordinal IS NOT NULL").select("file", "ordinal", "doc_id")
    return documents.hint("merge").join(counted, ["file", "ordinal"]).select("doc_id", "n_tokens")
