-- Shared CTE chain for every oracle query (DuckDB SQL).
-- Bindings (testdata -> raw tables, see FIXTURES.md), then Silver, then the marts
-- as_of = 2024-02-10, run_ts = 2024-02-10 00:00:00 and the same tie-breaks as lakeops.
raw_clients_base AS (
    SELECT
        c.c_custkey AS id,
        c.c_name AS name,
        CASE c.c_mktsegment
            WHEN 'BUILDING' THEN 'HOME_SERVICES'
            WHEN 'AUTOMOBILE' THEN 'AUTO'
            WHEN 'MACHINERY' THEN 'LEGAL'
            WHEN 'HOUSEHOLD' THEN 'DENTAL'
            ELSE 'MED_SPA' END AS industry,
        CASE WHEN c.c_acctbal < 2500 THEN 'Starter'
             WHEN c.c_acctbal < 6500 THEN 'Pro'
             ELSE 'Enterprise' END AS plan_tier,
        strftime(DATE '2023-01-01' + CAST(c.c_custkey % 181 AS INTEGER), '%Y-%m-%d') AS onboard_date,
        n.n_name AS city,
        r.r_name AS state,
        TIMESTAMP '2024-01-31 00:00:00' AS _loaded_at
    FROM customer c
    JOIN nation n ON c.c_nationkey = n.n_nationkey
    JOIN region r ON n.n_regionkey = r.r_regionkey
),
raw_clients AS (
    SELECT * FROM raw_clients_base
    UNION ALL
    SELECT id, name, industry, 'Starter' AS plan_tier, onboard_date, city, state,
           TIMESTAMP '2024-01-30 00:00:00' AS _loaded_at
    FROM raw_clients_base WHERE id % 10 = 0
),
raw_leads_base AS (
    SELECT
        o_orderkey AS id,
        CASE WHEN o_custkey % 50 = 7 THEN -o_custkey ELSE o_custkey END AS client_id,
        CASE o_orderkey % 4 WHEN 0 THEN 'Organic' WHEN 1 THEN 'Paid' WHEN 2 THEN 'Referral' WHEN 3 THEN 'Social' END AS source,
        CASE o_orderpriority
            WHEN '1-URGENT' THEN 'Converted'
            WHEN '2-HIGH' THEN 'Qualified'
            WHEN '3-MEDIUM' THEN 'Contacted'
            WHEN '4-NOT SPECIFIED' THEN 'New'
            ELSE 'Lost' END AS status,
        o_totalprice AS value,
        CAST(DATE '2024-01-01' + CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) % 30 AS INTEGER) AS TIMESTAMP) AS created_at,
        TIMESTAMP '2024-01-31 00:00:00' AS _loaded_at
    FROM orders
),
raw_leads AS (
    SELECT * FROM raw_leads_base
    UNION ALL
    SELECT id, client_id, source, 'New' AS status, value, created_at,
           TIMESTAMP '2024-01-30 00:00:00' AS _loaded_at
    FROM raw_leads_base WHERE id % 20 = 0
),
raw_appointments AS (
    SELECT
        l.l_orderkey * 8 + l.l_linenumber AS id,
        l.l_orderkey AS lead_id,
        CASE WHEN o.o_custkey % 50 = 7 THEN -o.o_custkey ELSE o.o_custkey END AS client_id,
        CAST(DATE '2024-01-01' + CAST(date_diff('day', DATE '1995-01-01', CAST(o.o_orderdate AS DATE)) % 30
                                      + l.l_partkey % 14 + 1 AS INTEGER) AS TIMESTAMP) AS scheduled_at,
        CASE l.l_returnflag WHEN 'N' THEN 'Scheduled' WHEN 'A' THEN 'Completed' WHEN 'R' THEN 'Cancelled' END AS status,
        l.l_linestatus AS notes,
        CAST(l.l_shipdate AS TIMESTAMP) AS _loaded_at
    FROM lineitem l
    JOIN orders o ON l.l_orderkey = o.o_orderkey
),
raw_ad_spend AS (
    SELECT
        client_id, channel, date, spend,
        CASE WHEN k % 10 = 0 THEN 0 ELSE k * 100 END AS impressions,
        CASE WHEN k % 7 = 0 THEN 0 ELSE k END AS clicks,
        _dlt_load_time
    FROM (
        SELECT
            user_id AS client_id,
            CASE event_type WHEN 'view' THEN 'google' WHEN 'purchase' THEN 'Google'
                            WHEN 'click' THEN 'meta' WHEN 'signup' THEN 'email'
                            WHEN 'error' THEN 'unattributed' END AS channel,
            strftime(ts, '%Y-%m-%d') AS date,
            value AS spend,
            CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
            CAST(ts AS TIMESTAMP) AS _dlt_load_time
        FROM events
    )
),
raw_seo_rankings AS (
    SELECT
        l.l_suppkey AS client_id,
        p.p_name AS keyword,
        CAST(l.l_quantity AS INTEGER) AS position,
        strftime(date_trunc('week', l.l_shipdate), '%Y-%m-%d') AS snapshot_date,
        TIMESTAMP '2024-02-10 00:00:00' AS _dlt_load_time
    FROM lineitem l
    JOIN part p ON l.l_partkey = p.p_partkey
),
stg_clients AS (
    SELECT
        md5(coalesce(CAST(id AS VARCHAR), '_dbt_utils_surrogate_key_null_')) AS client_key,
        CAST(id AS INTEGER) AS client_id,
        name AS client_name,
        lower(industry) AS industry,
        lower(plan_tier) AS plan_tier,
        CAST(onboard_date AS DATE) AS onboard_date,
        city,
        state,
        CAST(_loaded_at AS TIMESTAMP) AS _loaded_at
    FROM (
        SELECT *, row_number() OVER (
            PARTITION BY id
            ORDER BY _loaded_at DESC NULLS LAST, name DESC NULLS LAST, industry DESC NULLS LAST,
                     plan_tier DESC NULLS LAST, onboard_date DESC NULLS LAST, city DESC NULLS LAST,
                     state DESC NULLS LAST) AS _row_num
        FROM raw_clients
    ) WHERE _row_num = 1
),
stg_leads AS (
    SELECT
        md5(coalesce(CAST(id AS VARCHAR), '_dbt_utils_surrogate_key_null_')) AS lead_key,
        CAST(id AS INTEGER) AS lead_id,
        CAST(client_id AS INTEGER) AS client_id,
        lower(source) AS lead_source,
        lower(status) AS lead_status,
        CAST(value AS DECIMAL(10, 2)) AS lead_value,
        CAST(created_at AS TIMESTAMP) AS created_at,
        CAST(_loaded_at AS TIMESTAMP) AS _loaded_at
    FROM (
        SELECT *, row_number() OVER (
            PARTITION BY id
            ORDER BY _loaded_at DESC NULLS LAST, status DESC NULLS LAST, source DESC NULLS LAST,
                     value DESC NULLS LAST, created_at DESC NULLS LAST, client_id DESC NULLS LAST) AS _row_num
        FROM raw_leads
    ) WHERE _row_num = 1
),
stg_appointments AS (
    SELECT
        md5(coalesce(CAST(id AS VARCHAR), '_dbt_utils_surrogate_key_null_')) AS appointment_key,
        CAST(id AS INTEGER) AS appointment_id,
        CAST(lead_id AS INTEGER) AS lead_id,
        CAST(client_id AS INTEGER) AS client_id,
        CAST(scheduled_at AS TIMESTAMP) AS scheduled_at,
        lower(status) AS appointment_status,
        notes,
        CAST(_loaded_at AS TIMESTAMP) AS _loaded_at
    FROM (
        SELECT *, row_number() OVER (
            PARTITION BY id
            ORDER BY _loaded_at DESC NULLS LAST, scheduled_at DESC NULLS LAST, status DESC NULLS LAST,
                     notes DESC NULLS LAST, lead_id DESC NULLS LAST, client_id DESC NULLS LAST) AS _row_num
        FROM raw_appointments
    ) WHERE _row_num = 1
),
stg_seo_rankings AS (
    SELECT
        md5(coalesce(CAST(client_id AS VARCHAR), '_dbt_utils_surrogate_key_null_') || '-' ||
            coalesce(CAST(keyword AS VARCHAR), '_dbt_utils_surrogate_key_null_') || '-' ||
            coalesce(CAST(snapshot_date AS VARCHAR), '_dbt_utils_surrogate_key_null_')) AS seo_key,
        CAST(client_id AS INTEGER) AS client_id,
        keyword,
        CAST(position AS INTEGER) AS position,
        CAST(snapshot_date AS DATE) AS snapshot_date,
        TIMESTAMP '2024-02-10 00:00:00' AS _loaded_at
    FROM raw_seo_rankings
),
stg_ad_spend AS (
    SELECT
        md5(coalesce(CAST(client_id AS VARCHAR), '_dbt_utils_surrogate_key_null_') || '-' ||
            coalesce(CAST(channel AS VARCHAR), '_dbt_utils_surrogate_key_null_') || '-' ||
            coalesce(CAST(date AS VARCHAR), '_dbt_utils_surrogate_key_null_')) AS ad_spend_key,
        CAST(client_id AS INTEGER) AS client_id,
        lower(channel) AS channel,
        CAST(date AS DATE) AS spend_date,
        CAST(spend AS DECIMAL(10, 2)) AS spend,
        CAST(impressions AS INTEGER) AS impressions,
        CAST(clicks AS INTEGER) AS clicks,
        TIMESTAMP '2024-02-10 00:00:00' AS _loaded_at
    FROM (
        SELECT *, row_number() OVER (
            PARTITION BY client_id, channel, date
            ORDER BY _dlt_load_time DESC NULLS LAST, spend DESC NULLS LAST, impressions DESC NULLS LAST,
                     clicks DESC NULLS LAST) AS _row_num
        FROM raw_ad_spend
    ) WHERE _row_num = 1
),
-- One event per lead or appointment; a client's totals are sums over its events.
client_events AS (
    SELECT client_id, 1 AS lead, CASE lead_status WHEN 'converted' THEN 1 ELSE 0 END AS won, 0 AS visit FROM stg_leads
    UNION ALL
    SELECT client_id, 0, 0, 1 FROM stg_appointments
),
client_totals AS (
    SELECT client_id, CAST(sum(lead) AS BIGINT) AS leads, CAST(sum(won) AS BIGINT) AS wins, CAST(sum(visit) AS BIGINT) AS visits
    FROM client_events GROUP BY ALL
),
dim_clients AS (
    SELECT
        client_key, client_id, client_name, industry, plan_tier, onboard_date, city, state,
        DATE '2024-02-10' - onboard_date AS days_active,
        ifnull(leads, 0) AS total_leads,
        ifnull(wins, 0) AS converted_leads,
        ifnull(visits, 0) AS total_appointments,
        round(CAST(wins AS DOUBLE) / nullif(leads, 0), 4) AS lead_conversion_rate,
        _loaded_at
    FROM stg_clients LEFT JOIN client_totals USING (client_id)
),
fct_leads AS (
    SELECT
        lead_key, lead_id, client_id, industry, plan_tier, lead_source, lead_status, lead_value, created_at,
        lead_status IS NOT DISTINCT FROM 'converted' AS is_converted,
        EXISTS (SELECT 1 FROM stg_appointments v WHERE v.lead_id = l.lead_id) AS has_appointment,
        DATE '2024-02-10' - CAST(created_at AS DATE) AS age_days,
        l._loaded_at
    FROM stg_leads l LEFT JOIN stg_clients USING (client_id)
),
-- Leads of the row's client on the row's day, counted per spend row.
spend_with_leads AS (
    SELECT s.*, (SELECT count(*) FROM stg_leads l
                 WHERE l.client_id = s.client_id AND date_trunc('day', l.created_at) = s.spend_date) AS daily_leads
    FROM stg_ad_spend s
),
fct_ad_performance AS (
    SELECT
        ad_spend_key, client_id, industry, plan_tier, channel, spend_date, spend, impressions, clicks,
        round(CAST(clicks AS DOUBLE) / nullif(impressions, 0), 4) AS ctr,
        round(CAST(spend AS DOUBLE) / nullif(clicks, 0), 2) AS cpc,
        daily_leads,
        round(CAST(spend AS DOUBLE) / nullif(daily_leads, 0), 2) AS cpl,
        s._loaded_at
    FROM spend_with_leads s LEFT JOIN stg_clients USING (client_id)
),
fct_appointments AS (
    SELECT
        v.appointment_key, v.appointment_id, v.client_id, owner.industry, owner.plan_tier, v.lead_id,
        origin.lead_source, origin.lead_value, v.appointment_status, v.scheduled_at,
        origin.created_at AS lead_created_at,
        CAST(v.scheduled_at AS DATE) - CAST(origin.created_at AS DATE) AS days_to_appointment,
        v.appointment_status IS NOT DISTINCT FROM 'completed' AS is_completed,
        v._loaded_at
    FROM stg_appointments v
    LEFT JOIN stg_clients owner ON owner.client_id = v.client_id
    LEFT JOIN stg_leads origin ON origin.lead_id = v.lead_id
),
seo_top5 AS (
    SELECT client_id, rank, keyword, position FROM (
        SELECT client_id, keyword, position,
               row_number() OVER (PARTITION BY client_id
                                  ORDER BY position ASC NULLS LAST, keyword ASC NULLS LAST) AS rank
        FROM stg_seo_rankings
    ) WHERE rank <= 5
),
trailing_spend_30 AS (
    SELECT client_id,
           CAST(coalesce(sum(spend), 0) AS DOUBLE) AS monthly_spend_usd,
           round(avg(cpl), 6) AS avg_cpl
    FROM fct_ad_performance
    WHERE spend_date >= CAST(DATE '2024-02-10' - INTERVAL '30 days' AS DATE)
    GROUP BY client_id
),
client_context AS (
    SELECT
        d.client_id, d.client_name, d.industry, d.plan_tier, d.days_active, d.total_leads,
        d.converted_leads, d.lead_conversion_rate, d.total_appointments,
        coalesce(k.top_keywords, '[]') AS top_keywords,
        coalesce(s.monthly_spend_usd, 0.0) AS monthly_spend_usd,
        s.avg_cpl,
        '2024-02-10T00:00:00+00:00' AS last_updated
    FROM dim_clients d
    LEFT JOIN (
        SELECT client_id,
               CAST(to_json(list({'keyword': keyword, 'position': position} ORDER BY rank)) AS VARCHAR) AS top_keywords
        FROM seo_top5 GROUP BY client_id
    ) k ON d.client_id = k.client_id
    LEFT JOIN trailing_spend_30 s ON d.client_id = s.client_id
),
dim_clients_broken AS (
    -- the reference's negative contract case: client_name dropped
    SELECT client_key, client_id, industry, plan_tier, onboard_date, city, state,
           0 AS days_active, 0 AS total_leads, 0 AS converted_leads, 0 AS total_appointments,
           NULL AS lead_conversion_rate,
           CAST(TIMESTAMP '2024-02-10 00:00:00' AS TIMESTAMPTZ) AS _loaded_at
    FROM stg_clients
)
