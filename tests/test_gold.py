from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import functions as F

from lakeops.plans import gold

AS_OF = date(2024, 2, 10)
RUN_TS = datetime(2024, 2, 10)
LOADED = datetime(2024, 1, 31)

CLIENTS = "client_key string, client_id int, client_name string, industry string, plan_tier string, onboard_date date, city string, state string, _loaded_at timestamp_ntz"
LEADS = "lead_key string, lead_id int, client_id int, lead_source string, lead_status string, lead_value decimal(10,2), created_at timestamp_ntz, _loaded_at timestamp_ntz"
APPTS = "appointment_key string, appointment_id int, lead_id int, client_id int, scheduled_at timestamp_ntz, appointment_status string, notes string, _loaded_at timestamp_ntz"
ADS = "ad_spend_key string, client_id int, channel string, spend_date date, spend decimal(10,2), impressions int, clicks int, _loaded_at timestamp_ntz"


def clients(spark):
    return spark.createDataFrame(
        [
            ("k1", 1, "One", "legal", "pro", date(2023, 1, 1), "X", "Y", LOADED),
            ("k2", 2, "Two", "auto", "starter", date(2024, 2, 9), None, None, LOADED),
        ],
        CLIENTS,
    )


def leads(spark):
    return spark.createDataFrame(
        [
            ("l1", 10, 1, "paid", "converted", Decimal("100.00"), datetime(2024, 1, 5, 23, 0), LOADED),
            ("l2", 11, 1, "organic", None, None, datetime(2024, 1, 5, 9, 0), LOADED),
            ("l3", 12, 1, "social", "new", Decimal("5.00"), datetime(2024, 1, 6), LOADED),
            ("l4", 13, 99, "paid", "converted", Decimal("1.00"), datetime(2024, 1, 5), LOADED),  # no client
        ],
        LEADS,
    )


def appts(spark):
    return spark.createDataFrame(
        [
            ("a1", 100, 10, 1, datetime(2024, 1, 7, 1, 0), "completed", None, LOADED),
            ("a2", 101, 10, 1, datetime(2024, 1, 8), "scheduled", None, LOADED),
            ("a3", 102, 555, 1, datetime(2024, 1, 8), None, None, LOADED),  # no lead
        ],
        APPTS,
    )


def test_dim_clients_counts_rates_and_zero_fill(spark):
    d = {r.client_id: r for r in gold.dim_clients(clients(spark), leads(spark), appts(spark), AS_OF).collect()}
    assert d[1].total_leads == 3 and d[1].converted_leads == 1 and d[1].total_appointments == 3
    assert d[1].lead_conversion_rate == 0.3333
    assert d[1].days_active == (AS_OF - date(2023, 1, 1)).days
    assert d[2].total_leads == 0 and d[2].converted_leads == 0 and d[2].total_appointments == 0
    assert d[2].lead_conversion_rate is None and d[2].days_active == 1


def test_fct_leads_orphans_flags_and_age(spark):
    f = {r.lead_id: r for r in gold.fct_leads(leads(spark), clients(spark), appts(spark), RUN_TS).collect()}
    assert len(f) == 4
    assert f[13].industry is None and f[13].plan_tier is None  # orphan lead survives
    assert f[11].is_converted is False  # NULL status -> false, not NULL
    assert f[10].has_appointment is True and f[12].has_appointment is False
    assert f[10].age_days == (date(2024, 2, 10) - date(2024, 1, 5)).days


def test_fct_appointments_without_lead_and_day_count(spark):
    f = {r.appointment_id: r for r in gold.fct_appointments(appts(spark), leads(spark), clients(spark)).collect()}
    assert len(f) == 3
    assert f[100].days_to_appointment == 2  # 01-05 23:00 -> 01-07 01:00 crosses two midnights
    assert f[100].is_completed is True and f[101].is_completed is False
    assert f[102].lead_source is None and f[102].days_to_appointment is None and f[102].is_completed is False


def test_fct_ad_performance_ratios_and_cpl_per_channel(spark):
    ads = spark.createDataFrame(
        [
            ("s1", 1, "google", date(2024, 1, 5), Decimal("10.00"), 1000, 30, LOADED),
            ("s2", 1, "meta", date(2024, 1, 5), Decimal("7.00"), 0, 0, LOADED),
            ("s3", 2, "email", date(2024, 1, 5), Decimal("3.00"), 10, 3, LOADED),
            ("s4", 3, "email", date(2024, 1, 5), Decimal("3.00"), 10, 3, LOADED),  # unknown client
        ],
        ADS,
    )
    f = {r.ad_spend_key: r for r in gold.fct_ad_performance(ads, clients(spark), leads(spark)).collect()}
    assert len(f) == 4
    # client 1 has 2 leads on 2024-01-05; every channel divides by both
    assert f["s1"].daily_leads == 2 and f["s2"].daily_leads == 2
    assert f["s1"].cpl == 5.0 and f["s2"].cpl == 3.5
    assert f["s1"].ctr == 0.03 and f["s1"].cpc == 0.33
    assert f["s2"].ctr is None and f["s2"].cpc is None  # zero impressions and clicks
    assert f["s3"].daily_leads == 0 and f["s3"].cpl is None  # no leads that day
    assert f["s4"].industry is None


def test_marts_have_contract_types(spark):
    from lakeops.operators.contracts import schema_diff
    from lakeops.plans.quality import MART_CONTRACTS

    marts = {
        "dim_clients": gold.dim_clients(clients(spark), leads(spark), appts(spark), AS_OF),
        "fct_leads": gold.fct_leads(leads(spark), clients(spark), appts(spark), RUN_TS),
        "fct_appointments": gold.fct_appointments(appts(spark), leads(spark), clients(spark)),
        "fct_ad_performance": gold.fct_ad_performance(spark.createDataFrame([], ADS), clients(spark), leads(spark)),
    }
    for name, df in marts.items():
        assert [p for p in schema_diff(df, MART_CONTRACTS[name]) if p[3] != "ok"] == [], name


def test_keys_do_not_travel_through_the_joins(spark, monkeypatch):
    """The joins of the facts see no key that can be made again from the key columns."""
    seen = []
    monkeypatch.setattr(gold, "enrich", lambda fact, *a, _f=gold.enrich: seen.append(fact) or _f(fact, *a))
    ld = leads(spark).withColumns({"lead_key": F.expr("md5(CAST(lead_id AS STRING))")})
    ap = appts(spark).withColumns({"appointment_key": F.expr("md5(CAST(appointment_id AS STRING))")})
    ads_ = spark.createDataFrame([(None, 1, "google", date(2024, 1, 5), Decimal("1.00"), 1, 1, LOADED)], ADS)
    ads_ = ads_.withColumns({"ad_spend_key": F.expr("md5('1-google-2024-01-05')")})
    marts = [
        (gold.fct_leads(ld, clients(spark), ap, RUN_TS), "lead_key", "lead_id"),
        (gold.fct_ad_performance(ads_, clients(spark), ld), "ad_spend_key", "'1-google-2024-01-05'"),
        (gold.fct_appointments(ap, ld, clients(spark)), "appointment_key", "appointment_id"),
    ]
    for mart, key, source in marts:
        assert mart.where(f"{key} IS DISTINCT FROM md5(CAST({source} AS STRING))").count() == 0 < mart.count()
    keys = ("lead_key", "ad_spend_key", "appointment_key", "appointment_key")
    for fact, key in zip(seen, keys, strict=True):
        assert {r[0] for r in fact.select(key).collect()} == {""}
