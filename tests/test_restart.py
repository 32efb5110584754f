"""A run goes on where an earlier one stopped, and leaves what is unchanged."""

from dataclasses import replace
from datetime import date, datetime

import pytest

from lakeops.plans import pipeline
from lakeops.session import shared_path
from lakeops.sources import bindings as B
from lakeops.sources.bronze import Lake

SF = "/root/testdata/sf0.001"


def identities(lake):
    layers = {"bronze": pipeline.RAW_TABLES, "silver": pipeline.SILVER_TABLES, "gold": pipeline.GOLD_TABLES}
    return {n: lake.identity(layer, n) for layer, names in layers.items() for n in names}


def test_a_killed_run_resumes_and_unchanged_tables_stay(spark, monkeypatch):
    raw = B.raw_tables(spark, SF)
    cfg = pipeline.PipelineConfig(
        root=shared_path(spark, "restart", unique=True), as_of=date(2024, 2, 10), run_ts=datetime(2024, 2, 10),
        raw=raw, gate="record", snapshots={n: "day 1" for n in raw},
    )
    lake = Lake(spark, cfg.root)

    def killed(*_, **__):
        raise RuntimeError("killed")

    with monkeypatch.context() as m:
        m.setattr(pipeline, "publish_table", killed)  # before the first mart
        with pytest.raises(RuntimeError, match="killed"):
            pipeline.run_all(spark, cfg)
    first = identities(lake)
    assert all(first[n] for n in pipeline.SILVER_TABLES) and not any(first[n] for n in pipeline.GOLD_TABLES)
    tables = pipeline.run_all(spark, cfg)
    second = identities(lake)
    assert {n: i for n, i in second.items() if n not in pipeline.GOLD_TABLES} == {n: i for n, i in first.items() if i}
    sums = {tuple(r) for r in pipeline.published_sums(spark, tables).collect()}
    assert len(sums) == 14

    pipeline.run_all(spark, cfg)
    assert identities(lake) == second  # nothing new, nothing written

    pipeline.run_all(spark, replace(cfg, snapshots=cfg.snapshots | {"raw_appointments": "day 2"}))
    third = identities(lake)
    changed = {n for n in third if third[n] != second[n]}
    assert changed == {"raw_appointments", "stg_appointments", "dim_clients", "fct_leads", "fct_appointments"}

    # a change in place counts as well, and so do other dates
    lake.write(lake.ref("bronze", "raw_clients").limit(0), "bronze", "raw_clients", mode="append")
    pipeline.build(lake, ["stg_clients", "stg_leads"], cfg.as_of, cfg.run_ts, resume=True)
    fourth = identities(lake)
    assert {n for n in fourth if fourth[n] != third[n]} == {"raw_clients", "stg_clients"}
    pipeline.build(lake, ["stg_leads"], cfg.as_of, datetime(2024, 2, 11), resume=True)
    assert identities(lake)["stg_leads"] != fourth["stg_leads"]
    assert {tuple(r) for r in pipeline.published_sums(spark, tables).collect()} == sums


def test_without_snapshots_all_is_written_again(spark):
    raw = {n: df for n, df in B.raw_tables(spark, SF).items() if n == "raw_clients"}
    cfg = pipeline.PipelineConfig(shared_path(spark, "restart", unique=True), date(2024, 2, 10), datetime(2024, 2, 10), raw)
    lake = Lake(spark, cfg.root)
    pipeline.load_bronze(lake, cfg)
    pipeline.build(lake, ["stg_clients"], cfg.as_of, cfg.run_ts)
    first = lake.identity("bronze", "raw_clients"), lake.identity("silver", "stg_clients")
    pipeline.load_bronze(lake, cfg)
    pipeline.build(lake, ["stg_clients"], cfg.as_of, cfg.run_ts)
    assert not set(first) & {lake.identity("bronze", "raw_clients"), lake.identity("silver", "stg_clients")}
