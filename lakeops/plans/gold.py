"""Gold models: a client dimension and three facts, each at one grain.

All joins are left equi-joins, so orphan facts survive with NULL client
attributes. Counts are aggregated *before* they are joined, so no join fans out.
``heavy`` lists values of a fact's join keys whose rows are joined apart (see
`lakeops.operators.joins.heavy_keys`); the rows of the mart are the same.
Surrogate keys of facts do not travel through the joins where they can be made
again from the columns that do (`lakeops.functions.keys.light_key_sql`).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.functions.keys import light_key_sql, whole_key_sql
from lakeops.functions.measures import days_between_sql, flag_sql, safe_ratio_sql, zero_fill_sql
from lakeops.operators.aggregates import counts_by
from lakeops.operators.joins import enrich, exists_flag

CLIENT_ATTRS = ("industry", "plan_tier")
Heavy = Mapping[str, Sequence]

# Projections are SQL expression text built by the ``*_sql`` helpers of
# ``lakeops.functions`` (the same expressions as their Column forms).
IS_CONVERTED = flag_sql("lead_status = 'converted'")
IS_COMPLETED = flag_sql("appointment_status = 'completed'")

# Key of a fact and the columns that it is made of.
LEAD_KEY = ("lead_key", "lead_id")
AD_SPEND_KEY = ("ad_spend_key", "client_id", "channel", "spend_date")
APPOINTMENT_KEY = ("appointment_key", "appointment_id")


def _day(value: date | str) -> date:
    return date.fromisoformat(value) if isinstance(value, str) else value


def _instant(value: datetime | str) -> datetime:
    return datetime.fromisoformat(value) if isinstance(value, str) else value


def _light(fact: DataFrame, key: Sequence[str]) -> DataFrame:
    return fact.withColumn(key[0], F.expr(light_key_sql(*key)))


def _whole(key: Sequence[str]) -> str:
    return f"{whole_key_sql(*key)} AS {key[0]}"


def lead_counts(leads: DataFrame) -> DataFrame:
    """Total and converted leads per client (C1 + C2)."""
    return counts_by(
        leads,
        ["client_id"],
        "total_leads",
        where={"converted_leads": "lead_status = 'converted'"},
    )


def appointment_counts(appointments: DataFrame) -> DataFrame:
    return counts_by(appointments, ["client_id"], "total_appointments")


def daily_lead_counts(leads: DataFrame) -> DataFrame:
    """Leads per client and calendar day of creation (C3)."""
    days = leads.selectExpr("client_id", "CAST(created_at AS DATE) AS lead_date")
    return counts_by(days, ["client_id", "lead_date"], "daily_leads")


def dim_clients(clients: DataFrame, leads: DataFrame, appointments: DataFrame, as_of: date | str) -> DataFrame:
    j = clients.join(lead_counts(leads), "client_id", "left").join(appointment_counts(appointments), "client_id", "left")
    return j.selectExpr(
        "client_key",
        "client_id",
        "client_name",
        "industry",
        "plan_tier",
        "onboard_date",
        "city",
        "state",
        f"{days_between_sql('onboard_date', _day(as_of))} AS days_active",
        f"{zero_fill_sql('total_leads')} AS total_leads",
        f"{zero_fill_sql('converted_leads')} AS converted_leads",
        f"{zero_fill_sql('total_appointments')} AS total_appointments",
        # NULL (no leads) and 0 both give NULL, as "coalesce(total, 0) = 0" does
        f"{safe_ratio_sql('converted_leads', 'total_leads', 4)} AS lead_conversion_rate",
        "_loaded_at",
    )


def fct_leads(
    leads: DataFrame, clients: DataFrame, appointments: DataFrame, run_ts: datetime | str, heavy: Heavy = {}
) -> DataFrame:
    j = enrich(_light(leads, LEAD_KEY), clients, "client_id", CLIENT_ATTRS, heavy.get("client_id", ()))
    j = exists_flag(j, appointments, "lead_id", "has_appointment")
    return j.selectExpr(
        _whole(LEAD_KEY),
        "lead_id",
        "client_id",
        "industry",
        "plan_tier",
        "lead_source",
        "lead_status",
        "lead_value",
        "created_at",
        f"{IS_CONVERTED} AS is_converted",
        "has_appointment",
        f"{days_between_sql('created_at', _instant(run_ts))} AS age_days",
        "_loaded_at",
    )


def daily_costs(ad_spend: DataFrame, leads: DataFrame) -> DataFrame:
    """``client_id, spend_date, spend, cpl`` of ``fct_ad_performance``, without its join to clients."""
    daily = daily_lead_counts(leads).withColumnRenamed("lead_date", "spend_date")
    j = ad_spend.select("client_id", "spend_date", "spend").join(daily, ["client_id", "spend_date"], "left")
    return j.selectExpr("client_id", "spend_date", "spend", f"{safe_ratio_sql('spend', 'daily_leads', 2)} AS cpl")


def fct_ad_performance(ad_spend: DataFrame, clients: DataFrame, leads: DataFrame, heavy: Heavy = {}) -> DataFrame:
    """Daily performance per client x channel; ``cpl`` divides each channel's
    spend by *all* of that client's leads that day (never sum ``daily_leads``
    over channels)."""
    daily = daily_lead_counts(leads).withColumnRenamed("lead_date", "spend_date")
    ads = _light(ad_spend, AD_SPEND_KEY)
    j = enrich(ads, clients, "client_id", CLIENT_ATTRS, heavy.get("client_id", ())).join(daily, ["client_id", "spend_date"], "left")
    return j.selectExpr(
        _whole(AD_SPEND_KEY),
        "client_id",
        "industry",
        "plan_tier",
        "channel",
        "spend_date",
        "spend",
        "impressions",
        "clicks",
        f"{safe_ratio_sql('clicks', 'impressions', 4)} AS ctr",
        f"{safe_ratio_sql('spend', 'clicks', 2)} AS cpc",
        f"{zero_fill_sql('daily_leads')} AS daily_leads",
        f"{safe_ratio_sql('spend', 'daily_leads', 2)} AS cpl",
        "_loaded_at",
    )


def fct_appointments(appointments: DataFrame, leads: DataFrame, clients: DataFrame, heavy: Heavy = {}) -> DataFrame:
    lead_cols = leads.selectExpr("lead_id", "lead_source", "lead_value", "created_at AS lead_created_at")
    j = enrich(_light(appointments, APPOINTMENT_KEY), lead_cols, "lead_id", lead_cols.columns[1:], heavy.get("lead_id", ()))
    j = enrich(j, clients, "client_id", CLIENT_ATTRS, heavy.get("client_id", ()))
    return j.selectExpr(
        _whole(APPOINTMENT_KEY),
        "appointment_id",
        "client_id",
        "industry",
        "plan_tier",
        "lead_id",
        "lead_source",
        "lead_value",
        "appointment_status",
        "scheduled_at",
        "lead_created_at",
        f"{days_between_sql('lead_created_at', 'scheduled_at')} AS days_to_appointment",
        f"{IS_COMPLETED} AS is_completed",
        "_loaded_at",
    )
