from datetime import datetime

from lakeops.operators.dedup import latest_by
from lakeops.plans import silver

T1, T2 = datetime(2024, 1, 30), datetime(2024, 1, 31)


def test_latest_by_keeps_newest_and_nulls_lose(spark):
    df = spark.createDataFrame(
        [(1, "old", T1), (1, "new", T2), (2, "null-ts", None), (2, "dated", T1)], "id int, v string, ts timestamp_ntz"
    )
    got = {r.id: r.v for r in latest_by(df, ["id"], "ts").collect()}
    assert got == {1: "new", 2: "dated"}


def test_latest_by_tiebreak_is_deterministic(spark):
    df = spark.createDataFrame([(1, "a", T2), (1, "b", T2)], "id int, v string, ts timestamp_ntz")
    for _ in range(3):
        assert latest_by(df.repartition(4), ["id"], "ts", ["v"]).first().v == "b"


def test_latest_by_plans_partial_group_limit(spark):
    df = spark.createDataFrame([(1, T1)], "id int, ts timestamp_ntz")
    plan = latest_by(df, ["id"], "ts")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def _raw_ads(spark, rows):
    return spark.createDataFrame(
        rows, "client_id long, channel string, date string, spend double, impressions int, clicks int, _dlt_load_time timestamp_ntz"
    )


def test_stg_ad_spend_mixed_case_channels_both_survive(spark):
    raw = _raw_ads(
        spark,
        [
            (1, "Google", "2024-01-05", 10.0, 100, 1, T1),
            (1, "google", "2024-01-05", 20.0, 200, 2, T1),
            (1, "google", "2024-01-05", 30.0, 300, 3, T2),
        ],
    )
    out = silver.stg_ad_spend(raw, T2).collect()
    assert len(out) == 2
    assert {r.channel for r in out} == {"google"}
    assert sorted(float(r.spend) for r in out) == [10.0, 30.0]
    assert len({r.ad_spend_key for r in out}) == 2


def test_stg_ad_spend_types(spark):
    raw = _raw_ads(spark, [(1, "Meta", "2024-01-05", 12.345, 100, 1, T1)])
    out = silver.stg_ad_spend(raw, T2)
    types = {f.name: f.dataType.simpleString() for f in out.schema.fields}
    assert types == {
        "ad_spend_key": "string", "client_id": "int", "channel": "string", "spend_date": "date",
        "spend": "decimal(10,2)", "impressions": "int", "clicks": "int", "_loaded_at": "timestamp_ntz",
    }
    r = out.first()
    assert r.channel == "meta" and str(r.spend) == "12.35" and r._loaded_at == T2


def test_stg_clients_casts_text_and_lowercases(spark):
    raw = spark.createDataFrame(
        [(7, "Acme", "LEGAL", "Pro", "2023-03-01", None, None, T1), (7, "Acme", "LEGAL", "Starter", "2023-03-01", None, None, T2)],
        "id long, name string, industry string, plan_tier string, onboard_date string, city string, state string, _loaded_at timestamp_ntz",
    )
    r = silver.stg_clients(raw).collect()
    assert len(r) == 1 and r[0].plan_tier == "starter" and r[0].industry == "legal"
    assert str(r[0].onboard_date) == "2023-03-01" and r[0].client_id == 7


def test_models_accept_empty_input(spark):
    raw = _raw_ads(spark, [])
    assert silver.stg_ad_spend(raw, T2).count() == 0


def test_stg_seo_has_no_dedup(spark):
    raw = spark.createDataFrame(
        [(1, "kw", 3, "2024-01-01", T1), (1, "kw", 3, "2024-01-01", T1)],
        "client_id long, keyword string, position int, snapshot_date string, _dlt_load_time timestamp_ntz",
    )
    assert silver.stg_seo_rankings(raw, T2).count() == 2


def test_latest_by_column_arguments_match_names(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(
        [(1, "a", T1), (1, "b", T2), (2, "c", None), (2, "d", T1), (3, "e", T1), (3, "f", T1)],
        "id int, v string, ts timestamp_ntz",
    )
    by_name = sorted(latest_by(df, ["id"], "ts", ["v"]).collect())
    by_column = sorted(latest_by(df, ["id"], F.col("ts"), [F.col("v")]).collect())
    assert by_name == by_column and [r.v for r in by_name] == ["b", "d", "f"]
