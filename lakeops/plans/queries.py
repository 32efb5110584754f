"""Every registered query: ``(spark, sf_dir) -> DataFrame`` over the test tables.

Each one reads the whole binding tables; nothing is sampled or capped.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.functions.keys import surrogate_key
from lakeops.functions.measures import flag
from lakeops.operators.aggregates import counts_by, distinct_keys
from lakeops.operators.cleaning import lowered, typed
from lakeops.operators.dedup import latest_by
from lakeops.operators.joins import enrich, exists_flag, heavy_keys
from lakeops.operators import checks as C
from lakeops.operators.contracts import contract_report, null_report
from lakeops.operators.uniqueness import repeated_keys
from lakeops.plans import context, gold, incremental, pipeline, quality, silver
from lakeops.session import configure, shared_path
from lakeops.sources.bronze import Lake, write_bronze
from lakeops.sources.files import read_csv_typed, read_json_array
from lakeops.sources.json_array import read_json_array_split
from lakeops.sources.landing import ingest_drops
from lakeops.streaming.ingest import ingest_new_csv, land_csv
from lakeops.sources import bindings as B

RUN_TS = B.RUN_TS
AS_OF = B.AS_OF


SILVER_OF = {
    "clients": "stg_clients",
    "leads": "stg_leads",
    "appointments": "stg_appointments",
    "seo": "stg_seo_rankings",
    "ad_spend": "stg_ad_spend",
}


class Models:
    """Lazy Silver and Gold DataFrames over one test folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = configure(spark)
        self.sf_dir = sf_dir
        self._cache: dict[str, DataFrame] = {}

    def _get(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = build()
        return self._cache[name]

    def raw(self, name: str) -> DataFrame:
        return self._get(name, lambda: getattr(B, name)(self.spark, self.sf_dir))

    @property
    def clients(self) -> DataFrame:
        return self._get("stg_clients", lambda: silver.stg_clients(self.raw("raw_clients")))

    @property
    def leads(self) -> DataFrame:
        return self._get("stg_leads", lambda: silver.stg_leads(self.raw("raw_leads")))

    @property
    def appointments(self) -> DataFrame:
        return self._get("stg_appointments", lambda: silver.stg_appointments(self.raw("raw_appointments")))

    @property
    def seo(self) -> DataFrame:
        return self._get("stg_seo_rankings", lambda: silver.stg_seo_rankings(self.raw("raw_seo_rankings"), RUN_TS))

    @property
    def ad_spend(self) -> DataFrame:
        return self._get("stg_ad_spend", lambda: silver.stg_ad_spend(self.raw("raw_ad_spend"), RUN_TS))

    @property
    def dim_clients(self) -> DataFrame:
        return self._get("dim_clients", lambda: gold.dim_clients(self.clients, self.leads, self.appointments, AS_OF))

    @property
    def fct_leads(self) -> DataFrame:
        return self._get("fct_leads", lambda: gold.fct_leads(self.leads, self.clients, self.appointments, RUN_TS))

    @property
    def fct_ad_performance(self) -> DataFrame:
        return self._get("fct_ad_performance", lambda: gold.fct_ad_performance(self.ad_spend, self.clients, self.leads))

    @property
    def fct_appointments(self) -> DataFrame:
        return self._get("fct_appointments", lambda: gold.fct_appointments(self.appointments, self.leads, self.clients))


    def published(self, *attrs: str) -> Models:
        """The named Silver tables are written once; all marts that share them read them back."""
        run = shared_path(self.spark, "silver", unique=True)

        def publish(attr: str) -> DataFrame:
            df = getattr(self, attr)
            df.write.parquet(f"{run}/{attr}")
            return self.spark.read.schema(df.schema).parquet(f"{run}/{attr}")

        for attr, df in zip(attrs, pipeline.each_table(publish, attrs, parallel_jobs=4), strict=True):
            self._cache[SILVER_OF[attr]] = df
        return self


def _model(attr: str) -> Callable[[SparkSession, str], DataFrame]:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return getattr(Models(spark, sf_dir), attr)

    q.__name__ = attr
    return q


# --- single operators (Silver) -------------------------------------------------


def q_dedup_latest_single(spark, sf_dir):
    raw = Models(spark, sf_dir).raw("raw_appointments")
    return latest_by(raw, ["id"], "_loaded_at", silver.APPOINTMENT_TIEBREAK)


def q_dedup_latest_composite(spark, sf_dir):
    raw = Models(spark, sf_dir).raw("raw_ad_spend")
    return latest_by(raw, ["client_id", "channel", "date"], "_dlt_load_time", silver.AD_SPEND_TIEBREAK)


def q_surrogate_key_single(spark, sf_dir):
    raw = Models(spark, sf_dir).raw("raw_clients")
    return raw.select("id", "_loaded_at", surrogate_key("id").alias("client_key"))


def q_surrogate_key_composite(spark, sf_dir):
    raw = Models(spark, sf_dir).raw("raw_seo_rankings")
    # NULL parts are forced into some rows to exercise the placeholder.
    parts = raw.select(
        F.when(F.col("position") % 11 == 0, F.lit(None)).otherwise(F.col("client_id")).alias("client_id"),
        F.when(F.col("position") % 7 == 0, F.lit(None)).otherwise(F.col("keyword")).alias("keyword"),
        "snapshot_date",
    )
    return parts.withColumn("seo_key", surrogate_key("client_id", "keyword", "snapshot_date"))


def q_cast_types(spark, sf_dir):
    raw = Models(spark, sf_dir).raw("raw_ad_spend")
    src = raw.select(
        "client_id",
        F.col("date").alias("spend_date"),
        F.col("date").alias("spend_ts"),
        "spend",
        "impressions",
        "clicks",
        F.col("_dlt_load_time").alias("load_date"),
    )
    return typed(
        src,
        {
            "client_id": "int",
            "spend_date": "date",
            "spend_ts": "timestamp_ntz",
            "spend": "decimal(10,2)",
            "impressions": "int",
            "clicks": "int",
            "load_date": "date",
        },
    )


def q_normalize_lower(spark, sf_dir):
    raw = Models(spark, sf_dir).raw("raw_leads")
    return lowered(raw.select("id", "source", "status"), ["source", "status"])


# --- single operators (Gold) ---------------------------------------------------


def q_join_left_single(spark, sf_dir):
    m = Models(spark, sf_dir)
    return enrich(m.leads.select("lead_id", "client_id"), m.clients, "client_id", gold.CLIENT_ATTRS)


def q_join_left_composite(spark, sf_dir):
    m = Models(spark, sf_dir)
    daily = gold.daily_lead_counts(m.leads).withColumnRenamed("lead_date", "spend_date")
    ads = m.ad_spend.select("ad_spend_key", "client_id", "spend_date")
    return ads.join(daily, ["client_id", "spend_date"], "left")


def q_join_heavy_keys(spark, sf_dir):
    """The appointment facts, with leads and clients that hold a thousandth of the rows joined apart."""
    m = Models(spark, sf_dir).published("clients", "leads", "appointments")
    heavy = heavy_keys(m.appointments, ["lead_id", "client_id"])
    return gold.fct_appointments(m.appointments, m.leads, m.clients, heavy)


def q_exists_heavy_keys(spark, sf_dir):
    """Which appointments' clients have leads, clients that hold a thousandth of the appointments joined apart."""
    m = Models(spark, sf_dir).published("leads", "appointments")
    facts = m.appointments.select("appointment_id", "client_id")
    return exists_flag(facts, m.leads, "client_id", "has_leads", heavy=heavy_keys(facts, ["client_id"])["client_id"])


def q_exists_flag(spark, sf_dir):
    m = Models(spark, sf_dir)
    return exists_flag(m.leads.select("lead_id"), m.appointments, "lead_id", "has_appointment")


def q_agg_count_by_key(spark, sf_dir):
    return counts_by(Models(spark, sf_dir).leads, ["client_id"], "total_leads")


def q_agg_count_filter(spark, sf_dir):
    return gold.lead_counts(Models(spark, sf_dir).leads)


def q_agg_count_by_day(spark, sf_dir):
    return gold.daily_lead_counts(Models(spark, sf_dir).leads)


def q_distinct_keys(spark, sf_dir):
    return distinct_keys(Models(spark, sf_dir).appointments, "lead_id")


def q_case_flag(spark, sf_dir):
    leads = Models(spark, sf_dir).leads
    # Some statuses are forced to NULL: the flag must then be false, not NULL.
    status = F.when(F.col("lead_id") % 9 == 0, F.lit(None)).otherwise(F.col("lead_status"))
    return leads.select("lead_id", status.alias("lead_status")).withColumn(
        "is_converted", flag(F.col("lead_status") == F.lit("converted"))
    )


def q_ratio_rate4(spark, sf_dir):
    perf = Models(spark, sf_dir).fct_ad_performance
    return perf.select("ad_spend_key", "clicks", "impressions", "ctr")


def q_ratio_cost2(spark, sf_dir):
    perf = Models(spark, sf_dir).fct_ad_performance
    return perf.select("ad_spend_key", "spend", "clicks", "daily_leads", "cpc", "cpl")


def q_date_diff_days(spark, sf_dir):
    m = Models(spark, sf_dir)
    return m.fct_appointments.select("appointment_id", "lead_created_at", "scheduled_at", "days_to_appointment")


# --- context ---------------------------------------------------------------------


def q_context_lookup(spark, sf_dir):
    return context.client_metrics(Models(spark, sf_dir).dim_clients)


def q_context_lookup_ids(spark, sf_dir):
    """Every client id of the ad spend is asked for, and its negative, which no client has."""
    m = Models(spark, sf_dir)
    ids = m.raw("raw_ad_spend").selectExpr("explode(array(client_id, -client_id)) AS client_id")
    return context.lookup_ids(context.client_metrics(m.dim_clients), ids)


def q_topk_keywords(spark, sf_dir):
    return context.top_keywords(Models(spark, sf_dir).seo, k=5)


def q_trailing_spend(spark, sf_dir):
    m = Models(spark, sf_dir)
    costs = gold.daily_costs(m.ad_spend, m.leads)
    return context.trailing_spend(costs, AS_OF, days=30, avg_places=context.AVG_PLACES)


def _snapshot(spark, sf_dir):
    m = Models(spark, sf_dir)
    costs = gold.daily_costs(m.ad_spend, m.leads)
    return context.snapshot(m.dim_clients, m.seo, costs, AS_OF, RUN_TS, avg_places=context.AVG_PLACES)


def q_client_context(spark, sf_dir):
    return context.snapshot_flat(_snapshot(spark, sf_dir))


def q_client_context_json(spark, sf_dir):
    return context.snapshot_json(_snapshot(spark, sf_dir))


# --- contracts and quality --------------------------------------------------------

BROKEN_DIM = "dim_clients_broken"


def broken_dim_clients(clients: DataFrame, run_ts=RUN_TS) -> DataFrame:
    """The reference's negative contract case: ``client_name`` dropped, constants typed loosely."""
    return clients.select(
        "client_key",
        "client_id",
        "industry",
        "plan_tier",
        "onboard_date",
        "city",
        "state",
        F.lit(0).alias("days_active"),
        F.lit(0).alias("total_leads"),
        F.lit(0).alias("converted_leads"),
        F.lit(0).alias("total_appointments"),
        F.lit(None).alias("lead_conversion_rate"),
        F.lit(run_ts.isoformat(sep=" ")).cast("timestamp").alias("_loaded_at"),
    )


def q_contract_diff(spark, sf_dir):
    m = Models(spark, sf_dir)
    parts = [contract_report(getattr(m, t), c, t) for t, c in quality.MART_CONTRACTS.items()]
    parts.append(contract_report(broken_dim_clients(m.clients), quality.MART_CONTRACTS["dim_clients"], BROKEN_DIM))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def q_contract_nulls(spark, sf_dir):
    """NOT NULL columns of a mart whose client id is lost in some rows."""
    broken = Models(spark, sf_dir).fct_leads.withColumn("client_id", F.expr("CASE WHEN client_id % 7 <> 0 THEN client_id END"))
    return null_report(broken, quality.MART_CONTRACTS["fct_leads"])


class Tables:
    """Name -> DataFrame resolver for check specs (raw, Silver and Gold names)."""

    def __init__(self, m: Models):
        self.m = m

    def __call__(self, name: str) -> DataFrame:
        if name.startswith("raw_"):
            return self.m.raw(name)
        if name == BROKEN_DIM:
            return broken_dim_clients(self.m.clients)
        attr = {stg: attr for attr, stg in SILVER_OF.items()}.get(name, name)
        return getattr(self.m, attr)


# Check specs take a resolver (name -> DataFrame or None) so that the DuckDB
# oracle can be generated from the very same declarations.
def spec_not_null(r):
    return {
        "fct_leads": [C.not_null("client_id"), C.not_null("industry")],
        "fct_ad_performance": [C.not_null("spend"), C.not_null("cpc")],
        "stg_appointments": [C.not_null("notes")],
    }


def spec_unique(r):
    return {
        "raw_clients": [C.unique("id")],
        "stg_clients": [C.unique("client_id")],
        "raw_appointments": [C.unique("id")],
        "stg_seo_rankings": [C.unique("seo_key")],
    }


def spec_unique_two_pass(r):
    return {
        "raw_clients": [C.unique("id"), C.not_null("id")],
        "raw_leads": [C.unique("id"), C.unique("client_id")],
        "raw_appointments": [C.unique("id")],
        "stg_leads": [C.unique("lead_id"), C.unique("lead_key")],
        "stg_ad_spend": [C.unique("ad_spend_key")],
    }


def spec_accepted_values(r):
    return {
        "raw_leads": [C.accepted_values("status", quality.LEAD_STATUSES)],
        "stg_leads": [C.accepted_values("lead_status", quality.LEAD_STATUSES)],
        "raw_ad_spend": [C.accepted_values("channel", quality.CHANNELS)],
        "stg_ad_spend": [C.accepted_values("channel", quality.CHANNELS)],
    }


def spec_relationships(r):
    return {
        "fct_leads": [C.relationship("client_id", r("dim_clients"), "client_id", "dim_clients")],
        "fct_appointments": [C.relationship("lead_id", r("fct_leads"), "lead_id", "fct_leads")],
        "stg_seo_rankings": [C.relationship("client_id", r("stg_clients"), "client_id", "stg_clients")],
    }


def spec_freshness(r):
    return {t: [C.freshness(col, w, e, RUN_TS)] for t, (col, w, e) in quality.SOURCE_FRESHNESS.items()}


def spec_staleness(r):
    silver_limit = quality.STALENESS_LIMITS["silver"]
    gold_limit = quality.STALENESS_LIMITS["gold"]
    return {
        "stg_clients": [C.staleness("_loaded_at", silver_limit, RUN_TS)],
        "stg_leads": [C.staleness("_loaded_at", silver_limit, RUN_TS)],
        "stg_seo_rankings": [C.staleness("_loaded_at", quality.STALENESS_LIMITS["stg_seo_rankings"], RUN_TS)],
        "stg_ad_spend": [C.staleness("_loaded_at", silver_limit, RUN_TS)],
        "dim_clients": [C.staleness("_loaded_at", gold_limit, RUN_TS)],
        "fct_appointments": [C.staleness("_loaded_at", gold_limit, RUN_TS)],
    }


# Row-count bounds are the reference's own (sized for its 500-client seed);
# pass and fail sides with other bounds are covered in tests/test_quality.py.
def spec_row_count_between(r):
    return {
        "dim_clients": [C.row_count_between(*quality.DIM_CLIENTS_ROWS)],
        "stg_clients": [quality.suite_checks(quality.SUITE_CLIENTS)[0]],
        "stg_leads": [quality.suite_checks(quality.SUITE_LEADS)[0]],
    }


def spec_row_count_min(r):
    return {"fct_leads": [C.row_count_min(quality.FCT_LEADS_MIN_ROWS)]}


def spec_row_count_near(r):
    return {
        "fct_ad_performance": [
            C.row_count_near(quality.FCT_AD_PERFORMANCE_EXPECTED_ROWS, quality.FCT_AD_PERFORMANCE_TOLERANCE)
        ],
    }


def spec_footers(r):
    counts = {"raw_clients": C.row_count_between(1, 500), "raw_leads": C.row_count_min(17_500)}
    counts["raw_ad_spend"] = C.row_count_near(10_000, 0.25)
    return {t: [*checks, *([counts[t]] if t in counts else [])] for t, checks in spec_freshness(r).items()}


def spec_required_columns(r):
    return {
        "dim_clients": [C.has_columns(quality.DIM_CLIENTS_REQUIRED)],
        BROKEN_DIM: [C.has_columns(quality.DIM_CLIENTS_REQUIRED)],
    }


def spec_between(r):
    return {
        "stg_leads": [C.between("lead_value", 0, 10_000)],
        "stg_seo_rankings": [C.between("position", 1, 100)],
        "fct_ad_performance": [C.between("ctr", 0, 1)],
    }


def spec_suite_clients(r):
    return {"stg_clients": quality.suite_checks(quality.SUITE_CLIENTS)}


def spec_suite_leads(r):
    return {"stg_leads": quality.suite_checks(quality.SUITE_LEADS)}


def spec_source_tests(r):
    return quality.declared_checks(quality.SOURCE_TESTS, _Lazy(r))


def spec_mart_tests(r):
    return quality.declared_checks(quality.MART_TESTS, _Lazy(r))


class _Lazy(dict):
    """Mapping view over a resolver, for ``declared_checks``."""

    def __init__(self, r):
        super().__init__()
        self.r = r

    def __getitem__(self, name):
        return self.r(name)


CHECK_SPECS = {
    "check_not_null": spec_not_null,
    "check_unique": spec_unique,
    "check_unique_two_pass": spec_unique_two_pass,
    "check_accepted_values": spec_accepted_values,
    "check_relationships": spec_relationships,
    "check_freshness": spec_freshness,
    "check_staleness": spec_staleness,
    "check_row_count_between": spec_row_count_between,
    "check_row_count_min": spec_row_count_min,
    "check_row_count_near": spec_row_count_near,
    "check_required_columns": spec_required_columns,
    "check_between": spec_between,
    "check_footers": spec_footers,
    "suite_clients": spec_suite_clients,
    "suite_leads": spec_suite_leads,
    "source_tests": spec_source_tests,
    "mart_tests": spec_mart_tests,
}


# Silver tables that several marts (or several passes) of one query read.
SHARED_SILVER = {
    "mart_tests": ("clients", "leads", "appointments", "ad_spend"),
    "check_unique_two_pass": ("leads", "ad_spend"),
}
TWO_PASS = ("check_unique_two_pass",)


def _checks_query(key, spec):
    shared = SHARED_SILVER.get(key, ())

    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        tables = Tables(Models(spark, sf_dir).published(*shared))
        checks = spec(tables)
        return C.run_many({t: tables(t) for t in checks}, checks, two_pass=key in TWO_PASS)

    q.__name__ = f"q_{key}"
    return q


def q_check_footers(spark, sf_dir):
    """Freshness and row counts of the landed Bronze tables from the footers of their files."""
    m = Models(spark, sf_dir)
    lake = Lake(spark, shared_path(spark, "check_footers", unique=True))
    checks = spec_footers(None)
    pipeline.each_table(lambda n: write_bronze(lake, m.raw(n), n, partition_by=BRONZE_PARTITIONS.get(n, ())), checks, parallel_jobs=5)
    return quality.from_footers(lake, {f"bronze.{t}": listed for t, listed in checks.items()})


def q_repeated_keys(spark, sf_dir):
    """Natural keys that occur in several landed rows, with their rows: re-sent rankings and ad spend."""
    m = Models(spark, sf_dir)
    seo = repeated_keys(m.raw("raw_seo_rankings"), ["client_id", "keyword", "snapshot_date"])
    spend = repeated_keys(m.raw("raw_ad_spend"), ["client_id", "channel", "date"])
    parts = [
        seo.selectExpr("'raw_seo_rankings' AS table_name", "client_id", "keyword AS part", "CAST(snapshot_date AS STRING) AS day", "rows"),
        spend.selectExpr("'raw_ad_spend' AS table_name", "client_id", "channel AS part", "CAST(date AS STRING) AS day", "rows"),
    ]
    return reduce(DataFrame.unionByName, parts)


# --- sources, sinks, stream, pipeline ---------------------------------------------

AD_SPEND_LANDED_SCHEMA = T.StructType(
    [
        T.StructField("client_id", T.LongType()),
        T.StructField("channel", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("spend", T.DoubleType()),
        T.StructField("impressions", T.IntegerType()),
        T.StructField("clicks", T.IntegerType()),
        T.StructField("_dlt_load_time", T.TimestampNTZType()),
    ]
)

BRONZE_PARTITIONS = {"raw_ad_spend": ("date",), "raw_seo_rankings": ("snapshot_date",)}


def _row_sum(df: DataFrame, columns: list[tuple[str, str]]) -> DataFrame:
    """Row count and sum of row hashes over all columns; doubles count in hundredths, instants in microseconds."""

    def text(name: str, kind: str) -> str:
        if kind == "timestamp_ntz":
            name = f"unix_micros(CAST({name} AS TIMESTAMP))"
        elif kind == "double":
            name = f"CAST(round({name} * 100) AS BIGINT)"
        return f"coalesce(CAST({name} AS STRING), '-')"

    hashed = f"md5(concat_ws('|', {', '.join(text(*c) for c in columns)}))"
    return df.selectExpr(f"CAST(conv(substr({hashed}, 1, 8), 16, 10) AS BIGINT) AS h").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("h").alias("row_sum")
    )


def q_bronze_roundtrip(spark, sf_dir):
    """Land the five raw tables twice (the second load replaces the first; partitioned where declared), read all back."""
    m = Models(spark, sf_dir)
    lake = Lake(spark, shared_path(spark, "bronze_roundtrip", unique=True))

    def land(name: str) -> str:
        parts = BRONZE_PARTITIONS.get(name, ())
        write_bronze(lake, m.raw(name), name, partition_by=parts)
        return write_bronze(lake, m.raw(name), name, partition_by=parts)

    written = pipeline.each_table(land, pipeline.RAW_TABLES, parallel_jobs=4)
    parts = [
        _row_sum(spark.table(full), m.raw(name).dtypes).select(F.lit(name).alias("table_name"), "row_count", "row_sum")
        for full, name in zip(written, pipeline.RAW_TABLES, strict=True)
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def q_bronze_stamp(spark, sf_dir):
    """Raw clients without a load time, landed with the run's."""
    lake = Lake(spark, shared_path(spark, "bronze_stamp", unique=True))
    unstamped = Models(spark, sf_dir).raw("raw_clients").drop("_loaded_at")
    return spark.table(write_bronze(lake, unstamped, "raw_clients", load_col="_loaded_at", run_ts=RUN_TS))


def q_ad_stream_ingest(spark, sf_dir):
    """Two CSV drops arrive; each ingest run appends only the new files; Silver dedups."""
    m = Models(spark, sf_dir)
    run = shared_path(spark, "ad_stream_ingest", unique=True)
    landing, table, ckpt = f"{run}/landing", f"{run}/bronze/raw_ad_spend", f"{run}/checkpoint"
    raw = m.raw("raw_ad_spend")
    first = F.coalesce(F.col("date") < F.lit("2024-01-16"), F.lit(False))  # a NULL date is in the second drop
    land_csv(raw.where(first), landing)
    ingest_new_csv(spark, landing, table, ckpt, schema=AD_SPEND_LANDED_SCHEMA)
    land_csv(raw.where(~first), landing)
    ingest_new_csv(spark, landing, table, ckpt, schema=AD_SPEND_LANDED_SCHEMA)
    return silver.stg_ad_spend(spark.read.parquet(table), RUN_TS)


def q_csv_scan(spark, sf_dir):
    """Ad spend landed as CSV with another column order, read back by name and typed."""
    path = shared_path(spark, "csv_scan", unique=True)
    raw = Models(spark, sf_dir).raw("raw_ad_spend")
    land_csv(raw.select(*reversed(raw.columns)), path)
    return read_csv_typed(spark, path, AD_SPEND_LANDED_SCHEMA)


def q_json_scan(spark, sf_dir):
    """Rankings landed as JSON Lines, read back typed."""
    path = shared_path(spark, "json_scan", unique=True)
    Models(spark, sf_dir).raw("raw_seo_rankings").drop("_dlt_load_time").write.json(path)
    return read_json_array(spark, path, json_lines=True)


LEAD_BUCKETS = 16


def q_ad_redelivery(spark, sf_dir):
    """Four drops of ad spend land; two are delivered again with clicks and without some rows. Their rows in
    Bronze are replaced, and Silver is refreshed for the days touched."""
    m = Models(spark, sf_dir)
    lake = Lake(spark, shared_path(spark, "ad_redelivery", unique=True))
    landing = f"{lake.root}/landing"
    raw = m.raw("raw_ad_spend").withColumn("part", F.expr("coalesce(client_id, 0) % 4"))
    for part in range(4):
        land_csv(raw.where(f"part = {part}").withColumn("clicks", F.lit(0)).drop("part"), f"{landing}/drop-{part}")
    incremental.ingest_ad_spend(lake, landing, RUN_TS, AD_SPEND_LANDED_SCHEMA)
    for part in (1, 3):
        final = raw.where(f"part = {part} AND NOT coalesce(impressions % 500 = 0, false)").drop("part")
        land_csv(final, f"{landing}/drop-{part}", mode="overwrite")
    incremental.ingest_ad_spend(lake, landing, RUN_TS, AD_SPEND_LANDED_SCHEMA)
    return lake.ref("silver", "stg_ad_spend").drop(incremental.REGION)


def _merged(spark, sf_dir, raw_name, name, model, parts, region, raw_region):
    """Raw rows land in drops; after each, Silver is refreshed for the regions that occur in it."""
    lake = Lake(spark, shared_path(spark, f"merge_{name}", unique=True))
    raw = Models(spark, sf_dir).raw(raw_name)
    for part in parts:
        regions = incremental.land(lake, raw.where(f"coalesce({part}, false)"), raw_name, raw_region)
        incremental.refresh(lake, lake.ref("bronze", raw_name), name, model, regions, region)
    return lake.ref("silver", name).drop(incremental.REGION)


def q_merge_latest_single(spark, sf_dir):
    """Leads in three drops, re-sent ones in the last: merged by buckets of their key."""
    parts = (
        f"_loaded_at >= TIMESTAMP_NTZ '{B.CLIENT_LOAD_TS}' AND id % 2 = 0",
        f"_loaded_at >= TIMESTAMP_NTZ '{B.CLIENT_LOAD_TS}' AND id % 2 <> 0",
        f"_loaded_at < TIMESTAMP_NTZ '{B.CLIENT_LOAD_TS}'",
    )
    raw, own = (incremental.by_bucket(c, buckets=LEAD_BUCKETS) for c in ("CAST(id AS INT)", "lead_id"))
    return _merged(spark, sf_dir, "raw_leads", "stg_leads", silver.stg_leads, parts, own, raw)


def q_merge_latest_composite(spark, sf_dir):
    """Ad spend in three drops that share days and keys: merged by day."""
    day = "dayofmonth(CAST(date AS DATE))"
    parts = (f"{day} <= 12 AND impressions % 300 = 0", f"impressions % 300 <> 0 AND {day} <= 20", f"{day} > 12 AND (impressions % 300 = 0 OR {day} > 20)")
    rest = " OR ".join(f"coalesce({p}, false)" for p in parts)
    model = partial(silver.stg_ad_spend, run_ts=RUN_TS)
    raw, own = map(incremental.by_date, incremental.AD_DAY)
    return _merged(spark, sf_dir, "raw_ad_spend", "stg_ad_spend", model, (*parts, f"NOT ({rest})"), own, raw)


def q_json_array_scan(spark, sf_dir):
    """Rankings landed as files that hold one JSON array each, one by each task, read back in blocks."""
    path = shared_path(spark, "json_array_scan", unique=True)
    raw = Models(spark, sf_dir).raw("raw_seo_rankings").drop("_dlt_load_time")

    def arrays(batches):
        opened = False
        for batch in batches:
            if batch.num_rows:
                marks = np.full(batch.num_rows, ",", object)
                marks[0] = "," if opened else "["
                lines = pc.binary_join_element_wise(pa.array(marks, pa.string()), batch.column(0).cast(pa.string()), "")
                yield pa.RecordBatch.from_arrays([lines], names=["value"])
                opened = True
        yield pa.RecordBatch.from_arrays([pa.array(["]" if opened else "[]"])], names=["value"])

    raw.selectExpr("to_json(struct(*)) AS value").mapInArrow(arrays, "value string").write.text(path)
    return read_json_array_split(spark, path, block_bytes=1 << 18)


def q_missing_input(spark, sf_dir):
    """Landed and missing inputs of both file readers: rows, or the error that names what is missing."""
    path = shared_path(spark, "missing_input", unique=True)
    m = Models(spark, sf_dir)
    m.raw("raw_seo_rankings").drop("_dlt_load_time").write.json(f"{path}/seo")
    land_csv(m.raw("raw_ad_spend"), f"{path}/ads")
    readers = {
        "seo": lambda p: read_json_array(spark, p, json_lines=True),
        "ads": lambda p: read_csv_typed(spark, p, AD_SPEND_LANDED_SCHEMA),
    }
    parts = []
    for name, read in readers.items():
        parts.append(read(f"{path}/{name}").groupBy().count().selectExpr(f"'{name}' AS input", "CAST(NULL AS STRING) AS error", "count AS row_count"))
        try:
            read(f"{path}/no-{name}")
        except FileNotFoundError as e:
            found = str(e).replace(path, "")
            parts.append(parts[0].selectExpr(f"'no-{name}' AS input", f"'{found}' AS error", "CAST(NULL AS BIGINT) AS row_count"))
    return reduce(DataFrame.unionByName, parts)


def q_mart_on_views(spark, sf_dir):
    """The ad performance mart built on Silver views over landed Bronze tables."""
    m = Models(spark, sf_dir)
    lake = Lake(spark, shared_path(spark, "mart_on_views", unique=True))
    names = ("raw_clients", "raw_leads", "raw_ad_spend")
    pipeline.each_table(lambda n: write_bronze(lake, m.raw(n), n), names, parallel_jobs=3)
    pipeline.build(lake, ("stg_clients", "stg_leads", "stg_ad_spend"), AS_OF, RUN_TS, silver_views=True)
    (mart,) = pipeline.build(lake, ("fct_ad_performance",), AS_OF, RUN_TS)
    return spark.table(mart)


def q_lookup_bloom(spark, sf_dir):
    """One lead's appointments from the published mart, which has Bloom filters on ``lead_id``."""
    m = Models(spark, sf_dir)
    lake = Lake(spark, shared_path(spark, "lookup_bloom", unique=True))
    name = lake.write(m.fct_appointments, "gold", "fct_appointments", bloom=("lead_id",))
    return spark.table(name).where(F.col("lead_id") == 42)


def q_gate_failures(spark, sf_dir):
    """The failed checks that the gate raises for both suites."""
    m = Models(spark, sf_dir)
    suites = {"stg_clients": quality.SUITE_CLIENTS, "stg_leads": quality.SUITE_LEADS}
    tables = {"stg_clients": m.clients, "stg_leads": m.leads}
    results = C.run_many(tables, {t: quality.suite_checks(s) for t, s in suites.items()})
    try:
        C.gate(results)
    except C.QualityGateFailed as e:
        return spark.createDataFrame(e.failures, results.schema)
    return results.limit(0)


def q_pipeline_counts(spark, sf_dir):
    """The full run on the bindings; the gate records instead of stopping (the
    reference's suite bounds are for 500 clients and fail on these tables)."""
    m = Models(spark, sf_dir)
    cfg = pipeline.PipelineConfig(
        root=shared_path(spark, "pipeline", unique=True),
        as_of=AS_OF,
        run_ts=RUN_TS,
        raw={name: m.raw(name) for name in pipeline.RAW_TABLES},
        gate="record",
        two_pass_unique=True,
    )
    tables = pipeline.run_all(spark, cfg)
    return pipeline.published_sums(spark, tables)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "dedup_latest_single": q_dedup_latest_single,
    "dedup_latest_composite": q_dedup_latest_composite,
    "surrogate_key_single": q_surrogate_key_single,
    "surrogate_key_composite": q_surrogate_key_composite,
    "cast_types": q_cast_types,
    "normalize_lower": q_normalize_lower,
    "stg_clients": _model("clients"),
    "stg_leads": _model("leads"),
    "stg_appointments": _model("appointments"),
    "stg_seo_rankings": _model("seo"),
    "stg_ad_spend": _model("ad_spend"),
    "dim_clients": _model("dim_clients"),
    "fct_leads": _model("fct_leads"),
    "fct_ad_performance": _model("fct_ad_performance"),
    "fct_appointments": _model("fct_appointments"),
    "join_left_single": q_join_left_single,
    "join_left_composite": q_join_left_composite,
    "exists_flag": q_exists_flag,
    "join_heavy_keys": q_join_heavy_keys,
    "exists_heavy_keys": q_exists_heavy_keys,
    "agg_count_by_key": q_agg_count_by_key,
    "agg_count_filter": q_agg_count_filter,
    "agg_count_by_day": q_agg_count_by_day,
    "distinct_keys": q_distinct_keys,
    "case_flag": q_case_flag,
    "ratio_rate4": q_ratio_rate4,
    "ratio_cost2": q_ratio_cost2,
    "date_diff_days": q_date_diff_days,
    "context_lookup": q_context_lookup,
    "context_lookup_ids": q_context_lookup_ids,
    "topk_keywords": q_topk_keywords,
    "trailing_spend": q_trailing_spend,
    "client_context": q_client_context,
    "client_context_json": q_client_context_json,
    "contract_diff": q_contract_diff,
    "contract_nulls": q_contract_nulls,
    **{k: _checks_query(k, v) for k, v in CHECK_SPECS.items()},
    "check_footers": q_check_footers,  # in place of the one on scans
    "repeated_keys": q_repeated_keys,
    "bronze_roundtrip": q_bronze_roundtrip,
    "bronze_stamp": q_bronze_stamp,
    "ad_stream_ingest": q_ad_stream_ingest,
    "csv_scan": q_csv_scan,
    "json_scan": q_json_scan,
    "json_array_scan": q_json_array_scan,
    "missing_input": q_missing_input,
    "ad_redelivery": q_ad_redelivery,
    "merge_latest_single": q_merge_latest_single,
    "merge_latest_composite": q_merge_latest_composite,
    "mart_on_views": q_mart_on_views,
    "lookup_bloom": q_lookup_bloom,
    "gate_failures": q_gate_failures,
    "pipeline_counts": q_pipeline_counts,
}
