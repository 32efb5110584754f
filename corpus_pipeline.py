"""Training-corpus pipeline: rules, near duplicates, repeated passages, mix, tokens.

STAGES are applied in order. Each takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of documents. ``run`` writes each stage's result to the shared folder and
reads it back as the next one's docs.

Defined cases: a null or empty text fails the quality rules. Documents of a null doc_id are no copies
of each other; of a repeated doc_id each text is judged by its own component, and of several rows in one
component one stays. Very long texts pass through every stage whole. Ties go to the smallest doc_id, then to a
hash of the row. Columns beside doc_id, text, lang, source and n_chars are passed on up to the
mix, whatever their names; the last stage gives doc_id, lang, source and its own. An empty
table gives an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lakeops.llm import bpe, mixing, quality_rules, simhash, suffix_dedup
from lakeops.llm.common import removed, table, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.keep_by_rules(docs, quality_rules.fit_rules(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component, the one with the smallest doc_id."""
    return simhash.without_near_duplicates(docs, length=3, distance=2)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that an earlier document has."""
    return suffix_dedup.without_repeats(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and the digest of what they decode to."""
    return bpe.encode(
        docs,
        public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
        public_tokenizers.PATTERN,
        ["doc_id", "lang", "source"],
        ("n_tokens", "ids", "decoded_sha256"),
    )


STAGES = [
    ("quality_rules", quality),
    ("simhash_near_dedup", near_duplicates),
    ("suffix_dedup", repeats),
    ("mixing", mix),
    ("byte_bpe", tokens),
]

#: SQL cannot express the forest, the covering code or the merge replay.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over all documents. A stage's files go once the next stage is written."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES[:-1]):
        made = written(stage(spark, docs, sf_dir), name)
        if k:
            removed(docs)
        docs = made
    return STAGES[-1][1](spark, docs, sf_dir)
