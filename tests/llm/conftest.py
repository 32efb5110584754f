import pytest
from pyspark.sql import functions as F

from .brute import DOCS

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows, and columns with names used inside the operators."""
    df = spark.createDataFrame(DOCS, "doc_id long, text string, lang string, source string, n_chars long")
    for name in ("size", "fp", "n", "block", "kept", "n_words", "ids", "score", "row", "anchor", "root", "times"):
        df = df.withColumn(name, F.lit(name))
    return df
