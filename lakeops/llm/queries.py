"""Registered queries of the operators: thin, over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bitsliced,
    bpe,
    conversation_repair,
    html_text,
    lexicon_bpe,
    licences,
    mixing,
    periodic_runs,
    quality_classifier,
    quality_rules,
    simhash,
    suffix_dedup,
    token_counts,
)
from .common import table, written

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
SEPARATOR = 50256  # free in the vocabulary
TRAINING_FOLD = "crc32(CAST(doc_id AS STRING)) % 5 <> 0"


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), length=3, distance=2)


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality_classifier.fit(docs, labels, where=TRAINING_FOLD)
    scored = quality_classifier.score(docs, model, ["doc_id"])
    return scored.selectExpr(
        "doc_id",
        "coalesce(crc32(CAST(doc_id AS STRING)) % 5 = 0, false) AS held_out",
        "score",
        "CAST(score >= 0.3 AS INT) AS predicted",
    )


def op3_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitsliced.top_k(table(spark, sf_dir, "embeddings"), k=10)


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path(VOCABULARY),
        public_tokenizers.PATTERN,
        ["doc_id"],
        ("n_tokens", "ids_sha256", "decoded_sha256"),
    )


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"), ["page_id", "url"])


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), ["doc_id"], kept="kept_sha256")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mix(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "source_size", "target", "taken")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rules = quality_rules.fit_rules(docs, table(spark, sf_dir, "labels"))
    return quality_rules.apply_rules(docs, rules, ["doc_id"])


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = token_counts.write_token_files(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path(VOCABULARY),
        public_tokenizers.PATTERN,
        SEPARATOR,
    )
    return token_counts.document_tokens(manifest, SEPARATOR)


#: Documents have no paths. The query lays them out as source/lang/shelf/doc_id.txt, some higher up.
DOCUMENT_PATH = """concat_ws('/', coalesce(source, '-'),
    CASE WHEN doc_id % 1000 >= 10 THEN coalesce(lang, '-') END,
    CASE WHEN doc_id % 1000 >= 100 THEN CAST(doc_id % 50 AS STRING) END,
    concat(doc_id, '.txt'))"""


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of at most 80 words with a licence header stand in for the licence files of their directory."""
    files = table(spark, sf_dir, "documents").select(
        "doc_id",
        F.expr(DOCUMENT_PATH).alias("path"),
        F.expr("regexp_count(text, '[^\\\\x20\\\\x09-\\\\x0D]+') <= 80").alias("short"),
        "text",
    )
    found = written(licences.headers(files, ["doc_id", "path", "short"]), "headers")  # read three times
    return licences.inherit(found, is_licence_file="short").drop("short")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conversation_repair.damaged(table(spark, sf_dir, "conversations"))
    return conversation_repair.repair_digests(rows)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = periodic_runs.with_planted_runs(table(spark, sf_dir, "documents").select("doc_id", "text"))
    columns = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    return periodic_runs.detect(docs, ["doc_id"], columns)


def op13_lexicon_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexicon_bpe.encode(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        ["doc_id"],
        ("n_tokens", "ids_sha256", "decoded_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_simhash_near_dedup,
        op2_quality_classifier,
        op3_exact_topk,
        op4_byte_bpe,
        op5_html_text,
        op6_suffix_dedup,
        op7_mixing,
        op8_quality_rules,
        op9_token_counts,
        op10_license_scan,
        op11_conversation_repair,
        op12_periodic_runs,
        op13_lexicon_bpe,
    )
}

ORACLE_SQL: dict[str, str] = {
    "op3_exact_topk": """
        WITH v AS (
            SELECT row_number() OVER () AS "row", vec_id,
                   [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS q
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
        ), s AS (
            SELECT a."row", a.vec_id AS query_id, b.vec_id AS vec_id,
                   CAST(coalesce(list_sum(
                       [coalesce(x[1], 0) * coalesce(x[2], 0) FOR x IN list_zip(a.q, b.q)]), 0) AS BIGINT) AS score
            FROM v a JOIN v b ON a."row" <> b."row"
            WHERE a.vec_id % 100 = 0
        ), r AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY "row" ORDER BY score DESC, vec_id) AS INTEGER) AS "rank"
            FROM s
        )
        SELECT query_id, "rank", vec_id, score FROM r WHERE "rank" <= 10
    """,
}
