"""File sources: one JSON array per file, typed CSV with header."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Raw landing schemas of the two file sources.
SEO_RANKINGS_SCHEMA = T.StructType(
    [
        T.StructField("client_id", T.LongType()),
        T.StructField("keyword", T.StringType()),
        T.StructField("position", T.IntegerType()),
        T.StructField("snapshot_date", T.StringType()),
    ]
)
AD_SPEND_SCHEMA = T.StructType(
    [
        T.StructField("client_id", T.LongType()),
        T.StructField("channel", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("spend", T.DoubleType()),
        T.StructField("impressions", T.IntegerType()),
        T.StructField("clicks", T.IntegerType()),
    ]
)
# Timestamps in landed text keep microseconds.
TIMESTAMP_TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def _missing(e: AnalysisException) -> bool:
    cond = getattr(e, "getCondition", None) or getattr(e, "getErrorClass", None)
    code = cond() if cond else None
    return code == "PATH_NOT_FOUND" or "Path does not exist" in str(e)


def _load(reader, path: str | list[str], fmt: str, what: str) -> DataFrame:
    try:
        return reader.format(fmt).load(path)
    except AnalysisException as e:
        if _missing(e):
            raise FileNotFoundError(f"{what} not found at {path}") from e
        raise


def read_json_array(
    spark: SparkSession, path: str, schema: T.StructType = SEO_RANKINGS_SCHEMA, json_lines: bool = False
) -> DataFrame:
    """Rows of files that each hold one JSON array of objects (``path`` may be a folder or glob).

    Spark does not split a file that holds one JSON array, so each file is one task here:
    ``json_array.read_json_array_split`` reads large ones in blocks, and JSON Lines (one
    object per line, ``json_lines=True``) split by themselves.
    """
    reader = spark.read.schema(schema).option("mode", "FAILFAST")
    if not json_lines:
        reader = reader.option("multiLine", True)
    return _load(reader, path, "json", "JSON input")


def read_csv_typed(spark: SparkSession, path: str | list[str], schema: T.StructType = AD_SPEND_SCHEMA) -> DataFrame:
    """CSV with a header, read by column name and typed by ``schema``.

    The header may name the columns in any order and have others besides; a
    column that it lacks raises ``ValueError``. All files of ``path`` (or of a list of paths) need the
    same header (another one fails the job). A value that does not parse
    (``abc`` for an int) fails the job instead of becoming NULL.
    """
    named = _load(spark.read.option("header", True), path, "csv", "CSV input").columns
    missing = [n for n in schema.fieldNames() if n not in named]
    if missing:
        raise ValueError(f"CSV input at {path} has no column {', '.join(missing)}")
    known = {f.name: f for f in schema.fields}
    in_order = T.StructType([known.get(n, T.StructField(n, T.StringType())) for n in named])
    reader = (
        spark.read.schema(in_order)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .option("timestampNTZFormat", TIMESTAMP_TEXT_FORMAT)
    )
    return _load(reader, path, "csv", "CSV input").select(*schema.fieldNames())
