import os
from dataclasses import replace
from datetime import date, datetime

import pytest

from lakeops.operators.checks import QualityGateFailed
from lakeops.plans import pipeline
from lakeops.sources import bindings as B
from lakeops.sources.bronze import Lake

SF = "/root/testdata/sf0.001"


def cfg(spark, root, gate):
    return pipeline.PipelineConfig(
        root=root,
        as_of=date(2024, 2, 10),
        run_ts=datetime(2024, 2, 10),
        raw=B.raw_tables(spark, SF),
        gate=gate,
    )


def test_gate_stops_before_gold(spark, tmpdir_path):
    # the reference's suite bounds (500 clients) fail on these tables
    with pytest.raises(QualityGateFailed):
        pipeline.run_all(spark, cfg(spark, f"{tmpdir_path}/lake", "raise"))
    assert not os.path.exists(f"{tmpdir_path}/lake/gold") or not os.listdir(f"{tmpdir_path}/lake/gold")
    assert os.path.exists(f"{tmpdir_path}/lake/quality/gate_results")


def test_full_run_and_rebuild_one_model(spark, tmpdir_path):
    root = f"{tmpdir_path}/lake"
    tables = pipeline.run_all(spark, cfg(spark, root, "record"))
    counts = {r.table_name: r.row_count for r in pipeline.published_counts(spark, tables).collect()}
    assert counts["stg_clients"] == 150 and counts["dim_clients"] == 150
    assert counts["fct_ad_performance"] == counts["stg_ad_spend"]
    tests = spark.table(tables["test_results"]).collect()
    assert len(tests) == 27 + 5 + 34 + 4  # source tests, freshness, mart tests, asset checks
    from lakeops.plans import context

    docs = spark.table(tables["client_context"])
    assert docs.count() == counts["dim_clients"]
    some_id = docs.select("client_id").first().client_id
    one = context.lookup(docs, some_id)
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert f"EqualTo(client_id,{some_id})" in plan
    assert one.count() == 1 and context.lookup(docs, -12345).count() == 0
    lake = Lake(spark, root)
    again = pipeline.build(lake, ["fct_leads"], date(2024, 2, 10), datetime(2024, 2, 10))
    assert spark.table(again[0]).count() == counts["fct_leads"]


def test_options_for_large_tables_give_the_same_tables(spark, tmpdir_path):
    large = {"two_pass_unique": True, "heavy_share": 0.005, "bloom": {"fct_leads": ("lead_id",)}}
    found = []
    for name, options in (("plain", {}), ("large", large)):
        run = pipeline.run_all(spark, replace(cfg(spark, f"{tmpdir_path}/{name}", "record"), **options))
        results = [set(map(tuple, spark.table(run[t]).collect())) for t in ("gate_results", "test_results")]
        found.append((set(map(tuple, pipeline.published_sums(spark, run).collect())), *results))
    assert found[0] == found[1]


def test_repeat_runs_are_equal(spark):
    from lakeops.plans.queries import QUERIES

    a = QUERIES["fct_appointments"](spark, SF)
    b = QUERIES["fct_appointments"](spark, SF)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_build_orders_models_by_what_they_read(spark, tmpdir_path):
    from lakeops.sources.bronze import write_bronze

    lake = Lake(spark, f"{tmpdir_path}/lake")
    for name in ("raw_clients", "raw_leads", "raw_appointments"):
        write_bronze(lake, B.raw_tables(spark, SF)[name], name)
    names = ["dim_clients", "stg_leads", "stg_appointments", "stg_clients"]
    built = pipeline.build(lake, names, date(2024, 2, 10), datetime(2024, 2, 10))
    assert [b.split(".")[1] for b in built] == names
    assert spark.table(built[0]).count() == 150


def test_failed_declared_tests_fail_the_run(spark, tmpdir_path):
    c = replace(cfg(spark, f"{tmpdir_path}/lake", "raise"), suites={})
    with pytest.raises(QualityGateFailed):
        pipeline.run_all(spark, c)
    assert os.path.exists(f"{tmpdir_path}/lake/quality/test_results")


def test_failed_write_keeps_the_old_table(spark, tmpdir_path):
    lake = Lake(spark, f"{tmpdir_path}/lake")
    name = lake.write(spark.range(3).selectExpr("id", "id % 2 AS part"), "gold", "numbers", partition_by=["part"])
    with pytest.raises(Exception, match="no more rows"):
        lake.write(spark.range(5).selectExpr("id", "raise_error('no more rows') AS part"), "gold", "numbers")
    assert sorted(r.id for r in spark.table(name).collect()) == [0, 1, 2]
    for n in (4, 6, 8):
        lake.write(spark.range(n), "gold", "numbers")
    assert spark.table(name).count() == 8
    lake.write(spark.range(2), "gold", "numbers", mode="append")
    assert lake.vacuum("gold", "numbers") == 2 and spark.table(name).count() == 10
    with pytest.raises(ValueError):
        lake.vacuum("gold", "numbers", keep=0)


def test_two_roots_stay_apart(spark, tmpdir_path):
    a, b = Lake(spark, f"{tmpdir_path}/a"), Lake(spark, f"{tmpdir_path}/b")
    names = [lake.write(spark.range(n), "gold", "numbers") for lake, n in ((a, 2), (b, 5))]
    assert [spark.table(n).count() for n in names] == [2, 5]
    assert a.ref("gold", "numbers").count() == 2
    assert Lake(spark, f"{tmpdir_path}/a").ref("gold", "numbers").count() == 2
    spark.sql(f"DROP TABLE {names[0]}")  # as in a new session: read from the newest version
    assert a.ref("gold", "numbers").count() == 2
    with pytest.raises(FileNotFoundError):
        a.ref("gold", "nothing")
    assert Lake(spark, f"{tmpdir_path}/c", namespace="team").table("gold", "x").startswith("team_gold")


def test_lookup_of_many_ids(spark):
    from lakeops.plans import context

    docs = spark.createDataFrame([(1, "a"), (2, "b")], "client_id int, client_name string")
    ids = spark.createDataFrame([(2,), (2,), (9,), (None,)], "client_id long")
    rows = {(r.client_id, r.known, r.client_name) for r in context.lookup_ids(docs, ids).collect()}
    assert rows == {(2, True, "b"), (9, False, None), (None, False, None)}


def test_build_rejects_unknown_model(spark, tmpdir_path):
    lake = Lake(spark, f"{tmpdir_path}/lake")
    with pytest.raises(KeyError):
        pipeline.build(lake, ["no_such_model"], date(2024, 2, 10), datetime(2024, 2, 10))


def test_publish_table_checks_contract_before_writing(spark, tmpdir_path):
    from lakeops.operators.contracts import ContractViolation
    from lakeops.plans.queries import broken_dim_clients
    from lakeops.plans.quality import MART_CONTRACTS
    from lakeops.sources.bronze import publish_table, publish_view

    clients = publish_view(spark.range(3).selectExpr(
        "md5(CAST(id AS STRING)) AS client_key", "CAST(id AS INT) AS client_id", "'n' AS client_name",
        "'legal' AS industry", "'pro' AS plan_tier", "DATE '2024-01-01' AS onboard_date",
        "CAST(NULL AS STRING) AS city", "CAST(NULL AS STRING) AS state",
        "TIMESTAMP_NTZ '2024-01-31 00:00:00' AS _loaded_at"), "clients_view")
    assert spark.table("clients_view").count() == 3
    lake = Lake(spark, f"{tmpdir_path}/lake")
    with pytest.raises(ContractViolation):
        publish_table(lake, broken_dim_clients(clients), "dim_clients", MART_CONTRACTS["dim_clients"])
    assert not __import__("os").path.exists(f"{tmpdir_path}/lake/gold/dim_clients")


def test_full_run_sends_packed_slots_instead_of_keys(spark, monkeypatch):
    from lakeops.plans import pipeline, queries

    seen = []
    monkeypatch.setattr(pipeline, "run_all", lambda s, cfg: seen.append(cfg) or {})
    monkeypatch.setattr(pipeline, "published_sums", lambda s, tables: None)
    queries.q_pipeline_counts(spark, SF)
    assert seen[0].two_pass_unique and set(seen[0].raw) == set(pipeline.RAW_TABLES)
