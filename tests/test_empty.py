"""Every model and operator accepts empty input and returns an empty (or all-zero) result."""

from datetime import date, datetime

from pyspark.sql import functions as F

from lakeops.operators import checks as C
from lakeops.operators.aggregates import counts_by, distinct_keys
from lakeops.operators.dedup import latest_by
from lakeops.operators.joins import enrich, exists_flag, orphans
from lakeops.operators.ranking import top_k
from lakeops.plans import context, gold, silver

RUN_TS = datetime(2024, 2, 10)
AS_OF = date(2024, 2, 10)

RAW = {
    "clients": "id long, name string, industry string, plan_tier string, onboard_date string, city string, state string, _loaded_at timestamp_ntz",
    "leads": "id long, client_id long, source string, status string, value double, created_at timestamp_ntz, _loaded_at timestamp_ntz",
    "appointments": "id long, lead_id long, client_id long, scheduled_at timestamp_ntz, status string, notes string, _loaded_at timestamp_ntz",
    "seo": "client_id long, keyword string, position int, snapshot_date string, _dlt_load_time timestamp_ntz",
    "ads": "client_id long, channel string, date string, spend double, impressions int, clicks int, _dlt_load_time timestamp_ntz",
}


def empty(spark, schema):
    return spark.createDataFrame([], schema)


def test_models_on_empty_input(spark):
    c = silver.stg_clients(empty(spark, RAW["clients"]))
    ld = silver.stg_leads(empty(spark, RAW["leads"]))
    a = silver.stg_appointments(empty(spark, RAW["appointments"]))
    s = silver.stg_seo_rankings(empty(spark, RAW["seo"]), RUN_TS)
    ad = silver.stg_ad_spend(empty(spark, RAW["ads"]), RUN_TS)
    marts = [
        gold.dim_clients(c, ld, a, AS_OF),
        gold.fct_leads(ld, c, a, RUN_TS),
        gold.fct_ad_performance(ad, c, ld),
        gold.fct_appointments(a, ld, c),
    ]
    for df in [c, ld, a, s, ad, *marts]:
        assert df.count() == 0
    doc = context.snapshot(marts[0], s, marts[2], AS_OF, RUN_TS)
    assert doc.count() == 0 and context.snapshot_json(doc).count() == 0
    assert context.trailing_spend(marts[2], AS_OF).count() == 0


def test_operators_on_empty_input(spark):
    df = empty(spark, "k int, v int, ts timestamp_ntz")
    assert latest_by(df, ["k"], "ts").count() == 0
    assert counts_by(df, ["k"], "n", where={"pos": F.col("v") > 0}).count() == 0
    assert distinct_keys(df, "k").count() == 0
    assert top_k(df, ["k"], [F.col("v")], 5).count() == 0
    assert enrich(df, empty(spark, "k int, a string"), "k", ["a"]).count() == 0
    assert exists_flag(df, df, "k", "hit").count() == 0
    assert orphans(df, "k", df, "k").count() == 0


def test_checks_on_empty_input_report_every_check(spark):
    df = empty(spark, "k int, s string, ts timestamp_ntz")
    parent = empty(spark, "k int")
    checks = [
        C.not_null("k"),
        C.unique("k"),
        C.accepted_values("s", ["a"]),
        C.between("k", 0, 1),
        C.row_count_between(0, 10),
        C.row_count_near(10, 0.5),
        C.has_columns(["k", "x"]),
        C.relationship("k", parent, "k", "p"),
        C.freshness("ts", None, None, RUN_TS),
    ]
    got = {r.check: r for r in C.run_checks(df, "t", checks).collect()}
    assert set(got) == {c.kind for c in checks}
    assert got["not_null"].success and got["unique"].success and got["relationship"].success
    assert got["row_count_between"].success and not got["row_count_near"].success
    assert got["freshness"].detail == "error"
