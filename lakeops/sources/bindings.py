"""Bindings: the driver's test tables stand in for the five raw marketing sources.

Each binding is a plain select over ``/root/testdata/sf*/<table>.parquet`` (the
same select, in DuckDB SQL, opens every oracle query in ``oracle/``). The rules
are fixture rules of this repository, documented in ``FIXTURES.md``.

Timestamps stay ``timestamp_ntz`` (wall clock, no zone), the Spark type that
equals the reference engine's ``TIMESTAMP``.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# Fixed fixture values (see FIXTURES.md §2).
RUN_TS = datetime(2024, 2, 10, 0, 0, 0)
AS_OF = RUN_TS.date()
CLIENT_LOAD_TS = "2024-01-31 00:00:00"
CLIENT_RESENT_TS = "2024-01-30 00:00:00"
ONBOARD_BASE = "2023-01-01"
LEAD_BASE = "2024-01-01"
ORDER_EPOCH = "1995-01-01"
INDUSTRY_BY_SEGMENT = {"BUILDING": "HOME_SERVICES", "AUTOMOBILE": "AUTO", "MACHINERY": "LEGAL", "HOUSEHOLD": "DENTAL"}
INDUSTRY_OTHER = "MED_SPA"
SOURCE_BY_KEY_MOD4 = {0: "Organic", 1: "Paid", 2: "Referral", 3: "Social"}
STATUS_BY_PRIORITY = {"1-URGENT": "Converted", "2-HIGH": "Qualified", "3-MEDIUM": "Contacted", "4-NOT SPECIFIED": "New"}
STATUS_OTHER = "Lost"
APPOINTMENT_STATUS_BY_FLAG = {"N": "Scheduled", "A": "Completed", "R": "Cancelled"}
CHANNEL_BY_EVENT = {"view": "google", "purchase": "Google", "click": "meta", "signup": "email", "error": "unattributed"}

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


_RELATIONS: dict[tuple[str, str], DataFrame] = {}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The test table ``name``; each file is resolved once per Spark application.

    Resolving a Parquet path lists it and infers its schema (a small job);
    the test tables are read-only, so the resolved relation is reused, as a
    catalog table would be.
    """
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    df = _RELATIONS.get(key)
    if df is None or df.sparkSession is not spark:
        df = spark.read.parquet(path)
        _RELATIONS[key] = df
    return df


def _case(col: str, mapping: dict, other) -> str:
    """``CASE col WHEN k THEN v ... ELSE other END`` as SQL text."""

    def q(v):
        return "NULL" if v is None else f"'{v}'" if isinstance(v, str) else str(v)

    whens = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in mapping.items())
    return f"CASE {col} {whens} ELSE {q(other)} END"


# Orders of every 50th customer (key 7 mod 50) point to a client id that does
# not exist: those customers have no leads (NULL conversion rate) and their
# leads are orphans that must survive the left joins. No row is dropped.
_CLIENT_OF_ORDER = "CASE WHEN o_custkey % 50 = 7 THEN -o_custkey ELSE o_custkey END"
_DAY30 = f"datediff(CAST(o_orderdate AS DATE), DATE '{ORDER_EPOCH}') % 30"

# The bindings are plain selects written as SQL expressions (one parse per
# select), mirroring the DuckDB text in oracle/base.sql.


def _with_resent(base: DataFrame, cond: str, changed: dict[str, str]) -> DataFrame:
    """Each row, plus an older re-sent copy (with ``changed`` columns) where ``cond`` holds.

    Same rows as ``base UNION ALL (changed copy of base WHERE cond)``, from one
    scan of the input instead of two.
    """
    cols = base.columns
    original = ", ".join(f"'{c}', {c}" for c in cols)
    copy = ", ".join(f"'{c}', {changed.get(c, c)}" for c in cols)
    return base.selectExpr(
        f"inline(CASE WHEN {cond} THEN array(named_struct({original}), named_struct({copy})) "
        f"ELSE array(named_struct({original})) END)"
    )


def raw_clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "customer")
    n = read(spark, sf_dir, "nation")
    r = read(spark, sf_dir, "region")
    base = (
        c.join(n, c.c_nationkey == n.n_nationkey)
        .join(r, n.n_regionkey == r.r_regionkey)
        .selectExpr(
            "c_custkey AS id",
            "c_name AS name",
            f"{_case('c_mktsegment', INDUSTRY_BY_SEGMENT, INDUSTRY_OTHER)} AS industry",
            "CASE WHEN c_acctbal < 2500 THEN 'Starter' WHEN c_acctbal < 6500 THEN 'Pro' ELSE 'Enterprise' END AS plan_tier",
            f"CAST(date_add(DATE '{ONBOARD_BASE}', CAST(c_custkey % 181 AS INT)) AS STRING) AS onboard_date",
            "n_name AS city",
            "r_name AS state",
            f"TIMESTAMP_NTZ '{CLIENT_LOAD_TS}' AS _loaded_at",
        )
    )
    # An older copy of every 10th client, re-sent with another tier; it must lose.
    return _with_resent(
        base, "id % 10 = 0", {"plan_tier": "'Starter'", "_loaded_at": f"TIMESTAMP_NTZ '{CLIENT_RESENT_TS}'"}
    )


def raw_leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = read(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS id",
        f"{_CLIENT_OF_ORDER} AS client_id",
        f"{_case('o_orderkey % 4', SOURCE_BY_KEY_MOD4, None)} AS source",
        f"{_case('o_orderpriority', STATUS_BY_PRIORITY, STATUS_OTHER)} AS status",
        "o_totalprice AS value",
        f"CAST(date_add(DATE '{LEAD_BASE}', CAST({_DAY30} AS INT)) AS TIMESTAMP_NTZ) AS created_at",
        f"TIMESTAMP_NTZ '{CLIENT_LOAD_TS}' AS _loaded_at",
    )
    # An older copy of every 20th lead, re-sent as new; it must lose.
    return _with_resent(base, "id % 20 = 0", {"status": "'New'", "_loaded_at": f"TIMESTAMP_NTZ '{CLIENT_RESENT_TS}'"})


def raw_appointments(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The small numbers that dates and part keys are reduced to travel through the join, not the values themselves.
    li = read(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey % 14 AS part_day", "l_returnflag", "l_linestatus", "l_shipdate"
    )
    o = read(spark, sf_dir, "orders").selectExpr("o_orderkey", "o_custkey", f"{_DAY30} AS order_day")
    return li.join(o, li.l_orderkey == o.o_orderkey).selectExpr(
        "l_orderkey * 8 + l_linenumber AS id",
        "l_orderkey AS lead_id",
        f"{_CLIENT_OF_ORDER} AS client_id",
        f"CAST(date_add(DATE '{LEAD_BASE}', CAST(order_day + part_day + 1 AS INT)) AS TIMESTAMP_NTZ) AS scheduled_at",
        f"{_case('l_returnflag', APPOINTMENT_STATUS_BY_FLAG, None)} AS status",
        "l_linestatus AS notes",
        "CAST(l_shipdate AS TIMESTAMP_NTZ) AS _loaded_at",
    )


def raw_ad_spend(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events")
    with_k = e.selectExpr("*", "CAST(get_json_object(props, '$.k') AS INT) AS k")
    return with_k.selectExpr(
        "user_id AS client_id",
        f"{_case('event_type', CHANNEL_BY_EVENT, None)} AS channel",
        "CAST(CAST(ts AS DATE) AS STRING) AS date",
        "value AS spend",
        "CASE WHEN k % 10 = 0 THEN 0 ELSE k * 100 END AS impressions",
        "CASE WHEN k % 7 = 0 THEN 0 ELSE k END AS clicks",
        "CAST(ts AS TIMESTAMP_NTZ) AS _dlt_load_time",
    )


def raw_seo_rankings(spark: SparkSession, sf_dir: str, run_ts: datetime = RUN_TS) -> DataFrame:
    li = read(spark, sf_dir, "lineitem")
    p = read(spark, sf_dir, "part")
    return li.join(p, li.l_partkey == p.p_partkey).selectExpr(
        "l_suppkey AS client_id",
        "p_name AS keyword",
        "CAST(l_quantity AS INT) AS position",
        "CAST(CAST(date_trunc('week', l_shipdate) AS DATE) AS STRING) AS snapshot_date",
        f"TIMESTAMP_NTZ '{run_ts.isoformat(sep=' ')}' AS _dlt_load_time",
    )


def raw_tables(spark: SparkSession, sf_dir: str, run_ts: datetime = RUN_TS) -> dict[str, DataFrame]:
    """All five raw tables, lazily."""
    return {
        "raw_clients": raw_clients(spark, sf_dir),
        "raw_leads": raw_leads(spark, sf_dir),
        "raw_appointments": raw_appointments(spark, sf_dir),
        "raw_seo_rankings": raw_seo_rankings(spark, sf_dir, run_ts),
        "raw_ad_spend": raw_ad_spend(spark, sf_dir),
    }
