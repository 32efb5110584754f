"""Silver models: typed, deduplicated tables with surrogate keys.

Each model is a lazy DataFrame function of its raw input. The clock never
enters a model: ``run_ts`` is passed in.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame

from lakeops.functions.keys import surrogate_key_sql
from lakeops.functions.measures import ts_sql
from lakeops.operators.dedup import latest_by

# The projections are SQL expression text (one parse per model); the keys use
# ``surrogate_key_sql``, the text form of ``functions.surrogate_key``.

# Tie-breaks after the load time. The reference leaves equal load times to
# chance; a total order makes every run return the same rows.
CLIENT_TIEBREAK = ("name", "industry", "plan_tier", "onboard_date", "city", "state")
LEAD_TIEBREAK = ("status", "source", "value", "created_at", "client_id")
APPOINTMENT_TIEBREAK = ("scheduled_at", "status", "notes", "lead_id", "client_id")
AD_SPEND_TIEBREAK = ("spend", "impressions", "clicks")


def stg_clients(raw: DataFrame) -> DataFrame:
    latest = latest_by(raw, ["id"], "_loaded_at", CLIENT_TIEBREAK)
    return latest.selectExpr(
        f"{surrogate_key_sql('id')} AS client_key",
        "CAST(id AS INT) AS client_id",
        "name AS client_name",
        "lower(industry) AS industry",
        "lower(plan_tier) AS plan_tier",
        "CAST(onboard_date AS DATE) AS onboard_date",
        "city",
        "state",
        "CAST(_loaded_at AS TIMESTAMP_NTZ) AS _loaded_at",
    )


def stg_leads(raw: DataFrame) -> DataFrame:
    latest = latest_by(raw, ["id"], "_loaded_at", LEAD_TIEBREAK)
    return latest.selectExpr(
        f"{surrogate_key_sql('id')} AS lead_key",
        "CAST(id AS INT) AS lead_id",
        "CAST(client_id AS INT) AS client_id",
        "lower(source) AS lead_source",
        "lower(status) AS lead_status",
        "CAST(value AS DECIMAL(10, 2)) AS lead_value",
        "CAST(created_at AS TIMESTAMP_NTZ) AS created_at",
        "CAST(_loaded_at AS TIMESTAMP_NTZ) AS _loaded_at",
    )


def stg_appointments(raw: DataFrame) -> DataFrame:
    latest = latest_by(raw, ["id"], "_loaded_at", APPOINTMENT_TIEBREAK)
    return latest.selectExpr(
        f"{surrogate_key_sql('id')} AS appointment_key",
        "CAST(id AS INT) AS appointment_id",
        "CAST(lead_id AS INT) AS lead_id",
        "CAST(client_id AS INT) AS client_id",
        "CAST(scheduled_at AS TIMESTAMP_NTZ) AS scheduled_at",
        "lower(status) AS appointment_status",
        "notes",
        "CAST(_loaded_at AS TIMESTAMP_NTZ) AS _loaded_at",
    )


def stg_seo_rankings(raw: DataFrame, run_ts: datetime | str) -> DataFrame:
    """No dedup by design: the source's composite key is declared unique."""
    return raw.selectExpr(
        f"{surrogate_key_sql('client_id', 'keyword', 'snapshot_date')} AS seo_key",
        "CAST(client_id AS INT) AS client_id",
        "keyword",
        "CAST(position AS INT) AS position",
        "CAST(snapshot_date AS DATE) AS snapshot_date",
        f"{ts_sql(run_ts)} AS _loaded_at",
    )


def stg_ad_spend(raw: DataFrame, run_ts: datetime | str) -> DataFrame:
    """Dedup on the *raw* (client, channel, date): ``Google`` and ``google`` both survive.

    The key hash uses the raw channel and raw date text too; lower-casing and
    typing happen after both.
    """
    latest = latest_by(raw, ["client_id", "channel", "date"], "_dlt_load_time", AD_SPEND_TIEBREAK)
    return latest.selectExpr(
        f"{surrogate_key_sql('client_id', 'channel', 'date')} AS ad_spend_key",
        "CAST(client_id AS INT) AS client_id",
        "lower(channel) AS channel",
        "CAST(date AS DATE) AS spend_date",
        "CAST(spend AS DECIMAL(10, 2)) AS spend",
        "CAST(impressions AS INT) AS impressions",
        "CAST(clicks AS INT) AS clicks",
        f"{ts_sql(run_ts)} AS _loaded_at",
    )
