"""Client context: metrics, top keywords and trailing spend in one document per client.

The reference answers one client per HTTP request with four queries. Here the
same computation is one plan for *all* clients (a table to publish); a single
client is the same plan with a pushed-down ``client_id`` filter.
"""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.functions.measures import round_half_away_sql
from lakeops.operators.ranking import top_k

METRIC_COLUMNS = (
    "client_id",
    "client_name",
    "industry",
    "plan_tier",
    "days_active",
    "total_leads",
    "converted_leads",
    "lead_conversion_rate",
    "total_appointments",
)
# Field order of the document, as the reference returns it.
DOCUMENT_FIELDS = (*METRIC_COLUMNS, "top_keywords", "monthly_spend_usd", "avg_cpl", "last_updated")
KEYWORD_TYPE = T.ArrayType(
    T.StructType([T.StructField("keyword", T.StringType()), T.StructField("position", T.IntegerType())])
)
AVG_PLACES = 6  # avg of doubles depends on summation order; compared at 6 places


def _only(df: DataFrame, client_id: int | None) -> DataFrame:
    return df if client_id is None else df.where(F.col("client_id") == F.lit(client_id))


def client_metrics(dim: DataFrame, client_id: int | None = None) -> DataFrame:
    """D1: the nine client metrics; one client when ``client_id`` is given (D7: unknown id -> no row)."""
    return _only(dim, client_id).select(*METRIC_COLUMNS)


def top_keywords(seo: DataFrame, k: int = 5, client_id: int | None = None) -> DataFrame:
    """D2: the ``k`` best (lowest) positions per client over all snapshots.

    A keyword may appear more than once (one row per snapshot). Ties are
    ordered by keyword; NULL positions sort last. Rows equal in position and
    keyword are interchangeable (the output is the same whichever ranks
    first), so the snapshot date is not computed for the ranking.
    """
    order: list[Column] = [F.col("position").asc_nulls_last(), F.col("keyword").asc_nulls_last()]
    ranked = top_k(_only(seo, client_id), ["client_id"], order, k, rank_col="rank")
    return ranked.select("client_id", "rank", "keyword", "position")


def trailing_spend(
    perf: DataFrame,
    as_of: date | str,
    days: int = 30,
    client_id: int | None = None,
    avg_places: int | None = None,
) -> DataFrame:
    """D3: spend and mean cost per lead since ``as_of - days`` (inclusive, no upper bound).

    ``perf`` needs ``client_id, spend_date, spend, cpl`` (``fct_ad_performance``,
    or ``gold.daily_costs`` without its client join). ``avg`` skips NULL ``cpl``;
    a client whose rows all lack it gets NULL. ``avg_places`` rounds the mean,
    for comparisons between engines only.
    """
    mean = "avg(cpl)" if avg_places is None else round_half_away_sql("avg(cpl)", avg_places)
    day = date.fromisoformat(as_of) if isinstance(as_of, str) else as_of
    window = _only(perf, client_id).where(f"spend_date >= date_sub(DATE '{day.isoformat()}', {int(days)})")
    return window.groupBy("client_id").agg(
        F.expr("CAST(sum(spend) AS DOUBLE) AS monthly_spend_usd"),
        F.expr(f"{mean} AS avg_cpl"),
    )


def keyword_lists(seo: DataFrame, k: int = 5, client_id: int | None = None) -> DataFrame:
    """D5: ``[{keyword, position}, ...]`` per client in rank order (at most ``k`` items)."""
    ranked = top_keywords(seo, k, client_id)
    return ranked.groupBy("client_id").agg(
        F.expr(
            "transform(sort_array(collect_list(struct(rank, keyword, position))), "
            "x -> named_struct('keyword', x.keyword, 'position', x.position)) AS top_keywords"
        )
    )


def iso_timestamp(run_ts: datetime) -> str:
    """D4: the snapshot time as ISO text with its UTC offset."""
    ts = run_ts if run_ts.tzinfo else run_ts.replace(tzinfo=timezone.utc)
    return ts.isoformat()


def snapshot(
    dim: DataFrame,
    seo: DataFrame,
    perf: DataFrame,
    as_of: date | str,
    run_ts: datetime,
    client_id: int | None = None,
    k: int = 5,
    days: int = 30,
    avg_places: int | None = None,
) -> DataFrame:
    """D6: one row per client with the 13 document fields, nested keyword list.

    Clients without keywords get ``[]``; without spend rows 0.0 and NULL cpl.
    The three inputs are reduced to one row per client before the joins.
    """
    metrics = client_metrics(dim, client_id)
    kw = keyword_lists(seo, k, client_id)
    spend = trailing_spend(perf, as_of, days, client_id, avg_places)
    doc = metrics.join(kw, "client_id", "left").join(spend, "client_id", "left")
    return doc.selectExpr(
        *METRIC_COLUMNS,
        f"coalesce(top_keywords, CAST(array() AS {KEYWORD_TYPE.simpleString()})) AS top_keywords",
        "coalesce(monthly_spend_usd, CAST(0 AS DOUBLE)) AS monthly_spend_usd",
        "avg_cpl",
        f"'{iso_timestamp(run_ts)}' AS last_updated",
    )


def snapshot_flat(doc: DataFrame) -> DataFrame:
    """The document with ``top_keywords`` as JSON text (flat, comparable columns)."""
    return doc.withColumn("top_keywords", F.to_json("top_keywords"))


def snapshot_json(doc: DataFrame) -> DataFrame:
    """``client_id`` and the whole document as one JSON text, NULL fields kept."""
    body = F.struct(*[F.col(c) for c in DOCUMENT_FIELDS])
    return doc.select("client_id", F.to_json(body, {"ignoreNullFields": "false"}).alias("context_json"))


def lookup_ids(published: DataFrame, ids: DataFrame) -> DataFrame:
    """D1/D7 for a table of requested ``client_id``: one row per distinct id, ``known`` false where there is no client."""
    asked = ids.select(F.col("client_id").alias("asked_id")).distinct()
    found = asked.join(published, F.col("asked_id") == F.col("client_id"), "left")
    rest = [c for c in published.columns if c != "client_id"]
    return found.select(
        F.col("asked_id").alias("client_id"), F.col("client_id").isNotNull().alias("known"), *[F.col(c) for c in rest]
    )


def lookup(published: DataFrame, client_id: int) -> DataFrame:
    """D1/D7 on the published document table: one row, or none for an unknown id.

    The equality reaches the Parquet scan as a pushed filter; with the table
    clustered by ``client_id`` only one row group is read.
    """
    return published.where(F.col("client_id") == F.lit(client_id))
