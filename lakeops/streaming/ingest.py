"""New-file ingest with Structured Streaming (the reference's file-arrival trigger).

The reference polls one CSV's modification time and starts a full run when it
changes. Here every *new* file in a landing folder is appended to the Bronze
table exactly once: the stream's checkpoint is the cursor, and an
``availableNow`` trigger processes whatever has arrived and stops, so the same
call serves a schedule or a sensor. A file rewritten under an existing name is
not read again: landing names must be unique (Spark's writers make them so).
``sources.landing`` takes in files that are delivered again under their name.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lakeops.sources.files import AD_SPEND_SCHEMA, TIMESTAMP_TEXT_FORMAT


NO_AGE_LIMIT = "36500d"


def ingest_new_csv(
    spark: SparkSession,
    landing: str,
    table_path: str,
    checkpoint: str,
    schema: T.StructType = AD_SPEND_SCHEMA,
    load_col: str = "_dlt_load_time",
    max_files_per_batch: int | None = None,
    archive_dir: str | None = None,
) -> StreamingQuery:
    """Append every CSV that arrived in ``landing`` since the last call to ``table_path``.

    Rows without ``load_col`` are stamped with the micro-batch time, so a
    re-sent key from a later file wins the Silver dedup. Returns the finished
    query (its ``recentProgress`` says how many rows each batch took).

    No file is left out for its age: Spark's default of seven days, counted
    from the newest file seen, is lifted. A file whose header is not the
    schema's column names in their order stops the stream with an error.

    At scale the landing folder's listing grows with every file ever landed:
    ``archive_dir`` moves processed files there (``cleanSource=archive``), so
    each trigger lists only new arrivals. ``max_files_per_batch`` bounds one
    micro-batch.
    """
    stream = (
        spark.readStream.schema(schema)
        .option("header", True)
        .option("mode", "FAILFAST")
        .option("enforceSchema", False)
        .option("maxFileAge", NO_AGE_LIMIT)
        .option("timestampNTZFormat", TIMESTAMP_TEXT_FORMAT)
    )
    if max_files_per_batch:
        stream = stream.option("maxFilesPerTrigger", str(max_files_per_batch))
    if archive_dir:
        stream = stream.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    rows = stream.csv(landing)
    if load_col not in schema.fieldNames():
        rows = rows.withColumn(load_col, F.current_timestamp().cast("timestamp_ntz"))
    query = (
        rows.writeStream.format("parquet")
        .option("path", table_path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(f"ingest failed: {query.exception()}")
    return query


def land_csv(df, landing: str, mode: str = "append") -> None:
    """Write one drop of rows into the landing folder (new, unique file names; ``overwrite`` delivers it again)."""
    (
        df.write.mode(mode)
        .option("header", True)
        .option("timestampNTZFormat", TIMESTAMP_TEXT_FORMAT)
        .csv(landing)
    )
