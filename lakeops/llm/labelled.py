"""Bounded, deterministic samples of labelled documents for fitting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, max_docs: int, where: str = "true") -> DataFrame:
    """Documents (doc_id, text, label) of at most ``max_docs`` labelled ids, the first by a seeded hash.

    Rows with a null id or label are no labels; an id labelled twice takes its smaller label.
    The ids are collected (``max_docs`` rows at most), so the join side has a proven size.
    A repeated doc_id may give repeated rows: callers reduce them by doc_id.
    """
    spark = docs.sparkSession
    ids = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
        .where(F.expr(where))
        .groupBy("doc_id")
        .agg(F.min(label).alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_docs)
        .collect()
    )
    chosen = spark.createDataFrame([(int(r["doc_id"]), int(r["label"])) for r in ids], "doc_id long, label int")
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
