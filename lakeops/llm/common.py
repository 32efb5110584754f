"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401 - makes pa.compute available
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: ``[^\x20\x09-\x0D]+``: words are what these six white-space characters separate.
#: ``bytes.split()`` splits on exactly these bytes.
SPACES = " \t\n\x0b\x0c\r"
WORD = "[^\\x20\\x09-\\x0D]+"

_LOCAL_DIR = "spark.checkpoint.dir"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; in local mode without one, a temporary folder."""
    found = spark.conf.get(_LOCAL_DIR, None)
    if found:
        return found.rstrip("/")
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get().rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    made = tempfile.mkdtemp(prefix="lakeops-llm-")
    spark.sparkContext.setCheckpointDir(made)
    return made


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bounded(df: DataFrame, row_bytes: int, most_bytes: int = 64 << 20) -> DataFrame:
    """A written table as a side of a join: broadcast if its rows take at most ``most_bytes`` of memory, else merged.

    Its size on disk, which Spark would go by, says little: repeated values compress well.
    """
    return F.broadcast(df) if df.count() * row_bytes <= most_bytes else df.hint("merge")


def removed(df: DataFrame) -> None:
    """Delete the files of a table that `written` gave and nothing reads any more."""
    spark = df.sparkSession
    for place in {file.rpartition("/")[0] for file in df.inputFiles()}:
        if "/llm-" in place:
            path = spark._jvm.org.apache.hadoop.fs.Path(place)
            path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def arrow_map(
    df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    return df.mapInArrow(fn, schema)


def text_bytes(column: pa.Array) -> list[bytes]:
    """The texts as UTF-8 bytes; a null is the empty text."""
    return [x if x is not None else b"" for x in column.cast(pa.large_binary()).to_pylist()]


def texts(column: pa.Array) -> list[str]:
    """The texts as strings. The rule for all operators: a null is the empty text, bytes that are not UTF-8 are U+FFFD."""
    try:
        return [x or "" for x in column.to_pylist()]
    except UnicodeDecodeError:
        return [x.decode("utf-8", "replace") for x in text_bytes(column)]


def slices(batches: Iterator[pa.RecordBatch], text: str, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds about ``most_bytes`` of text at most (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        i = batch.schema.get_field_index(text)
        column = batch.column(i)
        if column.nbytes <= most_bytes:
            yield batch
            continue
        sizes = pa.compute.fill_null(pa.compute.binary_length(column), 0).to_pylist()
        start, held = 0, 0
        for row, size in enumerate(sizes):
            if held and held + size > most_bytes:
                yield batch.slice(start, row - start)
                start, held = row, 0
            held += size
        yield batch.slice(start)


def release() -> None:
    """Give freed memory of this worker back to the system; workers live on between tasks."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)
