"""Final selects of the oracle queries, keyed like ``queries()``."""

# Columns of the raw tables as text, in column order: @ an instant, # a value in hundredths.
RAW_COLUMNS = {
    "raw_clients": "id name industry plan_tier onboard_date city state @_loaded_at",
    "raw_leads": "id client_id source status #value @created_at @_loaded_at",
    "raw_appointments": "id lead_id client_id @scheduled_at status notes @_loaded_at",
    "raw_seo_rankings": "client_id keyword position snapshot_date @_dlt_load_time",
    "raw_ad_spend": "client_id channel date #spend impressions clicks @_dlt_load_time",
}


def _row_sum(table: str) -> str:
    """Row count and sum of row hashes over all columns of a raw table."""

    def text(col: str) -> str:
        if col[0] == "@":
            return f"CAST(epoch_us({col[1:]}) AS VARCHAR)"
        if col[0] == "#":
            return f"CAST(CAST(round({col[1:]} * 100) AS BIGINT) AS VARCHAR)"
        return f"CAST({col} AS VARCHAR)"

    parts = " || '|' || ".join(f"coalesce({text(c)}, '-')" for c in RAW_COLUMNS[table].split())
    return f"""SELECT '{table}' AS table_name, count(*) AS row_count,
    CAST(sum(CAST('0x' || substr(md5({parts}), 1, 8) AS BIGINT)) AS BIGINT) AS row_sum FROM {table}"""


def _key_sum(table: str, key: str) -> str:
    """Row count and sum of keys (integer keys as they are, md5 keys by their first 8 digits)."""
    value = key if not key.endswith("_key") else f"CAST('0x' || substr({key}, 1, 8) AS BIGINT)"
    return f"""SELECT '{table}' AS table_name, count(*) AS row_count, CAST(sum({value}) AS BIGINT) AS key_sum FROM {table}"""


PIPELINE_KEYS = {
    "raw_clients": "id",
    "raw_leads": "id",
    "raw_appointments": "id",
    "raw_seo_rankings": "client_id",
    "raw_ad_spend": "client_id",
    "stg_clients": "client_key",
    "stg_leads": "lead_key",
    "stg_appointments": "appointment_key",
    "stg_seo_rankings": "seo_key",
    "stg_ad_spend": "ad_spend_key",
    "dim_clients": "client_key",
    "fct_leads": "lead_key",
    "fct_ad_performance": "ad_spend_key",
    "fct_appointments": "appointment_key",
}

FINALS: dict[str, str] = {
    "bronze_stamp": """
SELECT id, name, industry, plan_tier, onboard_date, city, state, TIMESTAMP '2024-02-10 00:00:00' AS _loaded_at
FROM raw_clients""",
    "context_lookup_ids": """
SELECT asked.client_id, d.client_id IS NOT NULL AS known, client_name, industry, plan_tier, days_active, total_leads,
       converted_leads, lead_conversion_rate, total_appointments
FROM (SELECT client_id FROM raw_ad_spend UNION SELECT -client_id FROM raw_ad_spend) asked
LEFT JOIN dim_clients d ON d.client_id = asked.client_id""",
    "contract_nulls": """
SELECT 'fct_leads' AS table_name, unnest(['lead_key', 'lead_id', 'client_id', 'created_at', 'is_converted']) AS column_name,
       unnest([0, 0, count(*) FILTER (WHERE client_id % 7 = 0), 0, 0]) AS null_rows
FROM fct_leads""",
    "csv_scan": "SELECT client_id, channel, date, spend, impressions, clicks, _dlt_load_time FROM raw_ad_spend",
    "json_scan": "SELECT client_id, keyword, position, snapshot_date FROM raw_seo_rankings",
    "stg_clients": "SELECT * FROM stg_clients",
    "stg_leads": "SELECT * FROM stg_leads",
    "stg_appointments": "SELECT * FROM stg_appointments",
    "stg_seo_rankings": "SELECT * FROM stg_seo_rankings",
    "stg_ad_spend": "SELECT * FROM stg_ad_spend",
    "dim_clients": "SELECT * FROM dim_clients",
    "fct_leads": "SELECT * FROM fct_leads",
    "fct_ad_performance": "SELECT * FROM fct_ad_performance",
    "fct_appointments": "SELECT * FROM fct_appointments",
    "dedup_latest_single": """
SELECT id, lead_id, client_id, scheduled_at, status, notes, _loaded_at FROM (
    SELECT *, row_number() OVER (
        PARTITION BY id
        ORDER BY _loaded_at DESC NULLS LAST, scheduled_at DESC NULLS LAST, status DESC NULLS LAST,
                 notes DESC NULLS LAST, lead_id DESC NULLS LAST, client_id DESC NULLS LAST) AS rn
    FROM raw_appointments
) WHERE rn = 1""",
    "dedup_latest_composite": """
SELECT client_id, channel, date, spend, impressions, clicks, _dlt_load_time FROM (
    SELECT *, row_number() OVER (
        PARTITION BY client_id, channel, date
        ORDER BY _dlt_load_time DESC NULLS LAST, spend DESC NULLS LAST, impressions DESC NULLS LAST,
                 clicks DESC NULLS LAST) AS rn
    FROM raw_ad_spend
) WHERE rn = 1""",
    "surrogate_key_single": """
SELECT id, _loaded_at, md5(coalesce(CAST(id AS VARCHAR), '_dbt_utils_surrogate_key_null_')) AS client_key
FROM raw_clients""",
    "surrogate_key_composite": """
SELECT client_id, keyword, snapshot_date,
       md5(coalesce(CAST(client_id AS VARCHAR), '_dbt_utils_surrogate_key_null_') || '-' ||
           coalesce(CAST(keyword AS VARCHAR), '_dbt_utils_surrogate_key_null_') || '-' ||
           coalesce(CAST(snapshot_date AS VARCHAR), '_dbt_utils_surrogate_key_null_')) AS seo_key
FROM (
    SELECT CASE WHEN position % 11 = 0 THEN NULL ELSE client_id END AS client_id,
           CASE WHEN position % 7 = 0 THEN NULL ELSE keyword END AS keyword,
           snapshot_date
    FROM raw_seo_rankings
)""",
    "cast_types": """
SELECT CAST(client_id AS INTEGER) AS client_id,
       CAST(date AS DATE) AS spend_date,
       CAST(date AS TIMESTAMP) AS spend_ts,
       CAST(spend AS DECIMAL(10, 2)) AS spend,
       CAST(impressions AS INTEGER) AS impressions,
       CAST(clicks AS INTEGER) AS clicks,
       CAST(_dlt_load_time AS DATE) AS load_date
FROM raw_ad_spend""",
    "normalize_lower": "SELECT id, lower(source) AS source, lower(status) AS status FROM raw_leads",
    "join_left_single": """
SELECT l.lead_id, l.client_id, c.industry, c.plan_tier
FROM stg_leads l LEFT JOIN stg_clients c ON l.client_id = c.client_id""",
    "join_left_composite": """
SELECT ad_spend_key, client_id, spend_date, nullif(daily_leads, 0) AS daily_leads FROM spend_with_leads""",
    "exists_flag": """
SELECT lead_id, EXISTS (SELECT 1 FROM stg_appointments v WHERE v.lead_id = l.lead_id) AS has_appointment
FROM stg_leads l""",
    "lookup_bloom": "SELECT * FROM fct_appointments WHERE lead_id = 42",
    "join_heavy_keys": "SELECT * FROM fct_appointments",
    "exists_heavy_keys": """
SELECT appointment_id, client_id, EXISTS (SELECT 1 FROM stg_leads l WHERE l.client_id = v.client_id) AS has_leads
FROM stg_appointments v""",
    "agg_count_by_key": "SELECT client_id, count(*) AS total_leads FROM stg_leads GROUP BY client_id",
    "agg_count_filter": "SELECT client_id, leads AS total_leads, wins AS converted_leads FROM client_totals WHERE leads > 0",
    "agg_count_by_day": "SELECT client_id, CAST(created_at AS DATE) AS lead_date, count(*) AS daily_leads FROM stg_leads GROUP BY ALL",
    "distinct_keys": "SELECT DISTINCT lead_id FROM stg_appointments",
    "case_flag": """
SELECT lead_id, lead_status,
       CASE WHEN lead_status = 'converted' THEN true ELSE false END AS is_converted
FROM (SELECT lead_id, CASE WHEN lead_id % 9 = 0 THEN NULL ELSE lead_status END AS lead_status FROM stg_leads)""",
    "ratio_rate4": "SELECT ad_spend_key, clicks, impressions, ctr FROM fct_ad_performance",
    "ratio_cost2": "SELECT ad_spend_key, spend, clicks, daily_leads, cpc, cpl FROM fct_ad_performance",
    "date_diff_days": """
SELECT appointment_id, lead_created_at, scheduled_at, days_to_appointment FROM fct_appointments""",
    "context_lookup": """
SELECT client_id, client_name, industry, plan_tier, days_active, total_leads, converted_leads,
       lead_conversion_rate, total_appointments
FROM dim_clients""",
    "topk_keywords": "SELECT client_id, CAST(rank AS INTEGER) AS rank, keyword, position FROM seo_top5",
    "trailing_spend": "SELECT client_id, monthly_spend_usd, avg_cpl FROM trailing_spend_30",
    "client_context": "SELECT * FROM client_context",
    "bronze_roundtrip": "\nUNION ALL\n".join(_row_sum(t) for t in RAW_COLUMNS),
    "ad_stream_ingest": "SELECT * FROM stg_ad_spend",
    "merge_latest_single": "SELECT * FROM stg_leads",
    "merge_latest_composite": "SELECT * FROM stg_ad_spend",
    "mart_on_views": "SELECT * FROM fct_ad_performance",
    "json_array_scan": "SELECT client_id, keyword, position, snapshot_date FROM raw_seo_rankings",
    "repeated_keys": """
SELECT 'raw_seo_rankings' AS table_name, client_id, keyword AS part, CAST(snapshot_date AS VARCHAR) AS day, count(*) AS rows
FROM raw_seo_rankings WHERE client_id IS NOT NULL AND keyword IS NOT NULL AND snapshot_date IS NOT NULL
GROUP BY ALL HAVING count(*) > 1
UNION ALL
SELECT 'raw_ad_spend', client_id, channel, CAST(date AS VARCHAR), count(*)
FROM raw_ad_spend WHERE client_id IS NOT NULL AND channel IS NOT NULL AND date IS NOT NULL
GROUP BY ALL HAVING count(*) > 1""",
    "missing_input": """
SELECT 'seo' AS input, CAST(NULL AS VARCHAR) AS error, count(*) AS row_count FROM raw_seo_rankings
UNION ALL SELECT 'no-seo', 'JSON input not found at /no-seo', NULL
UNION ALL SELECT 'ads', NULL, count(*) FROM raw_ad_spend
UNION ALL SELECT 'no-ads', 'CSV input not found at /no-ads', NULL""",
    # of the clients of parts 1 and 3 the second delivery counts, of the others the first, without clicks
    "ad_redelivery": """
SELECT md5(coalesce(CAST(client_id AS VARCHAR), '_dbt_utils_surrogate_key_null_') || '-' ||
           coalesce(CAST(channel AS VARCHAR), '_dbt_utils_surrogate_key_null_') || '-' ||
           coalesce(CAST(date AS VARCHAR), '_dbt_utils_surrogate_key_null_')) AS ad_spend_key,
       CAST(client_id AS INTEGER) AS client_id, lower(channel) AS channel, CAST(date AS DATE) AS spend_date,
       CAST(spend AS DECIMAL(10, 2)) AS spend, CAST(impressions AS INTEGER) AS impressions,
       CAST(clicks AS INTEGER) AS clicks, TIMESTAMP '2024-02-10 00:00:00' AS _loaded_at
FROM (
    SELECT *, row_number() OVER (
        PARTITION BY client_id, channel, date
        ORDER BY _dlt_load_time DESC NULLS LAST, spend DESC NULLS LAST, impressions DESC NULLS LAST, clicks DESC NULLS LAST) AS place
    FROM (
        SELECT * REPLACE (CASE WHEN coalesce(client_id, 0) % 4 IN (1, 3) THEN clicks ELSE 0 END AS clicks)
        FROM raw_ad_spend
        WHERE coalesce(client_id, 0) % 4 IN (0, 2) OR NOT coalesce(impressions % 500 = 0, false)
    )
) WHERE place = 1""",
    "pipeline_counts": "\nUNION ALL\n".join(_key_sum(t, k) for t, k in PIPELINE_KEYS.items()),
    "client_context_json": """
SELECT client_id,
       CAST(to_json({
           'client_id': client_id, 'client_name': client_name, 'industry': industry,
           'plan_tier': plan_tier, 'days_active': days_active, 'total_leads': total_leads,
           'converted_leads': converted_leads, 'lead_conversion_rate': lead_conversion_rate,
           'total_appointments': total_appointments, 'top_keywords': CAST(top_keywords AS JSON),
           'monthly_spend_usd': monthly_spend_usd, 'avg_cpl': avg_cpl, 'last_updated': last_updated
       }) AS VARCHAR) AS context_json
FROM client_context""",
}
