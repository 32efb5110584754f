"""The full run: Bronze -> Silver -> quality gate -> Gold -> tests, in one Spark application.

Models are a plain registry (name -> function and inputs); ``build`` resolves
inputs from published tables, so one model can be rebuilt alone.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import date, datetime
from functools import partial
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession

from lakeops.operators import checks as C
from lakeops.operators.joins import heavy_keys
from lakeops.plans import context, gold, quality, silver
from lakeops.sources.bronze import Lake, publish_table, row_counts, write_bronze

T = TypeVar("T")

RAW_TABLES = ("raw_clients", "raw_leads", "raw_appointments", "raw_seo_rankings", "raw_ad_spend")
SILVER_TABLES = ("stg_clients", "stg_leads", "stg_appointments", "stg_seo_rankings", "stg_ad_spend")
GOLD_TABLES = ("dim_clients", "fct_leads", "fct_ad_performance", "fct_appointments")


@dataclass(frozen=True)
class Model:
    layer: str
    build: Callable[..., DataFrame]
    inputs: tuple[str, ...]  # "layer.name"
    joins: tuple[str, ...] = ()  # join keys of the first input that may be heavy


def registry(as_of: date, run_ts: datetime) -> dict[str, Model]:
    """Model name -> how to build it from published inputs."""
    return {
        "stg_clients": Model("silver", silver.stg_clients, ("bronze.raw_clients",)),
        "stg_leads": Model("silver", silver.stg_leads, ("bronze.raw_leads",)),
        "stg_appointments": Model("silver", silver.stg_appointments, ("bronze.raw_appointments",)),
        "stg_seo_rankings": Model(
            "silver", partial(silver.stg_seo_rankings, run_ts=run_ts), ("bronze.raw_seo_rankings",)
        ),
        "stg_ad_spend": Model("silver", partial(silver.stg_ad_spend, run_ts=run_ts), ("bronze.raw_ad_spend",)),
        "dim_clients": Model(
            "gold",
            partial(gold.dim_clients, as_of=as_of),
            ("silver.stg_clients", "silver.stg_leads", "silver.stg_appointments"),
        ),
        "fct_leads": Model(
            "gold",
            partial(gold.fct_leads, run_ts=run_ts),
            ("silver.stg_leads", "silver.stg_clients", "silver.stg_appointments"),
            ("client_id",),
        ),
        "fct_ad_performance": Model(
            "gold",
            gold.fct_ad_performance,
            ("silver.stg_ad_spend", "silver.stg_clients", "silver.stg_leads"),
            ("client_id",),
        ),
        "fct_appointments": Model(
            "gold",
            gold.fct_appointments,
            ("silver.stg_appointments", "silver.stg_leads", "silver.stg_clients"),
            ("lead_id", "client_id"),
        ),
    }


@dataclass
class PipelineConfig:
    root: str
    as_of: date
    run_ts: datetime
    raw: Mapping[str, DataFrame] = field(default_factory=dict)  # raw name -> DataFrame to land
    partition_by: Mapping[str, tuple[str, ...]] = field(
        default_factory=lambda: {"raw_ad_spend": ("date",), "raw_seo_rankings": ("snapshot_date",)}
    )
    gate: str = "raise"  # "raise": stop before Gold on a failed check; "record": write results, go on
    suites: Mapping[str, Mapping] = field(
        default_factory=lambda: {"stg_clients": quality.SUITE_CLIENTS, "stg_leads": quality.SUITE_LEADS}
    )
    parallel_jobs: int = 4  # independent tables of one layer are written concurrently
    heavy_share: float | None = None  # join keys that hold this share of a fact's rows are joined apart
    # mart -> columns it is looked up by: Bloom filters per row group
    bloom: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    two_pass_unique: bool = False  # large tables: uniqueness without a shuffle of the keys (`operators.uniqueness`)
    # raw name -> what its rows are (a snapshot's id, a file's fingerprint): tables built from the same are not built again
    snapshots: Mapping[str, str] = field(default_factory=dict)


def each_table(fn: Callable[[str], T], names: Iterable[str], parallel_jobs: int) -> list[T]:
    """Run ``fn`` for independent tables, submitting their Spark jobs from a few threads.

    Only job submission happens on the driver; Spark schedules the jobs' tasks
    side by side, which keeps a large cluster busy when single tables are small.
    Results keep the input order; the first failure is raised.
    """
    names = list(names)
    if parallel_jobs <= 1 or len(names) <= 1:
        return [fn(n) for n in names]
    with ThreadPoolExecutor(max_workers=min(parallel_jobs, len(names))) as pool:
        return list(pool.map(fn, names))


def load_bronze(lake: Lake, cfg: PipelineConfig) -> list[str]:
    """A7: land every raw table (database tables, SEO file, ad spend file).

    A table whose published version is of the same snapshot (``cfg.snapshots``) is left as it is.
    """

    def one(name: str) -> str:
        parts = cfg.partition_by.get(name, ())
        made_of = f"{name} {cfg.snapshots[name]} {parts}" if name in cfg.snapshots else None
        if made_of is not None and lake.built_from("bronze", name) == made_of:
            return lake.table("bronze", name)
        return write_bronze(lake, cfg.raw[name], name, partition_by=parts, built_from=made_of)

    return each_table(one, cfg.raw, cfg.parallel_jobs)


def build(
    lake: Lake,
    names: Iterable[str],
    as_of: date,
    run_ts: datetime,
    contracts: bool = True,
    parallel_jobs: int = 1,
    silver_views: bool = False,
    resume: bool = False,
    heavy_share: float | None = None,
    bloom: Mapping[str, tuple[str, ...]] = {},
) -> list[str]:
    """build and publish the named models from their published inputs.

    With ``silver_views`` Silver models become views of this session instead of tables: nothing is written,
    and each mart that reads them computes them. Marts that share them do so each, so tables are the default.

    Each published version notes what it was built from: the model, its dates, and the identities of its inputs'
    versions. With ``resume`` a model is skipped where that is the same as now, so a run that failed goes on
    where it stopped, and one on unchanged inputs writes nothing. (A change of a model's code is not seen: build
    without ``resume`` then.)

    ``bloom`` names the columns of a mart by which single rows are looked up (see `Lake.write`).

    With ``heavy_share`` each fact is first searched for join keys that hold that share of its rows, in one pass; these
    are joined apart from the others, without a shuffle.

    Models are built after those of the named ones that they read, whatever the
    order of the names; models that do not need each other run side by side.
    """
    reg = registry(as_of, run_ts)
    names = list(dict.fromkeys(names))
    for name in names:
        if name not in reg:
            raise KeyError(f"unknown model {name}")

    def one(name: str) -> str:
        m = reg[name]
        read = {i: lake.identity(*i.split(".")) for i in m.inputs}
        made_of = f"{name} {as_of} {run_ts} {contracts} {sorted(read.items())}" if None not in read.values() else None
        if resume and made_of is not None and lake.built_from(m.layer, name) == made_of:
            return lake.table(m.layer, name)
        inputs = [lake.ref(*i.split(".")) for i in m.inputs]
        heavy = heavy_keys(inputs[0], m.joins, heavy_share) if heavy_share and m.joins else {}
        df = m.build(*inputs, heavy=heavy) if heavy else m.build(*inputs)
        if m.layer == "gold":
            contract = quality.MART_CONTRACTS[name] if contracts else None
            return publish_table(lake, df, name, contract, built_from=made_of, bloom=bloom.get(name, ()))
        if silver_views:
            return lake.view(df, m.layer, name)
        return lake.write(df, m.layer, name, built_from=made_of)

    done: dict[str, str] = {}
    while len(done) < len(names):
        waiting = [n for n in dict.fromkeys(names) if n not in done]
        ready = [n for n in waiting if not {i.split(".")[1] for i in reg[n].inputs} & set(waiting)]
        done.update(zip(ready, each_table(one, ready, parallel_jobs), strict=True))
    return [done[n] for n in names]


def run_all(spark: SparkSession, cfg: PipelineConfig) -> dict[str, str]:
    """Bronze -> Silver -> gate -> Gold -> tests. Returns table name -> catalog name.

    After the marts, the context document of every client is published as
    ``gold.client_context`` (clustered by ``client_id`` for point lookups).
    The tests (written to ``quality.test_results``) are the declared source
    tests and source freshness on Bronze, the declared mart tests and the
    row-count/schema checks on Gold. With ``gate="raise"`` a failed test fails
    the run, after its results are written.

    Where ``cfg.snapshots`` says what the raw rows are, tables that were built from the same inputs and dates
    are not written again: a run that failed goes on behind its last published table.
    """
    lake = Lake(spark, cfg.root)
    tables: dict[str, str] = {}
    for full in load_bronze(lake, cfg):
        tables[full.split(".")[1]] = full
    resume = bool(cfg.snapshots)
    for full in build(lake, SILVER_TABLES, cfg.as_of, cfg.run_ts, parallel_jobs=cfg.parallel_jobs, resume=resume):
        tables[full.split(".")[1]] = full
    if cfg.suites:
        gate_results = C.run_many(
            {t: lake.ref("silver", t) for t in cfg.suites},
            {t: quality.suite_checks(s) for t, s in cfg.suites.items()},
            cfg.two_pass_unique,
        )
        tables["gate_results"] = lake.write(gate_results, "quality", "gate_results")
        if cfg.gate == "raise":
            C.gate(lake.ref("quality", "gate_results"))
    how = {"parallel_jobs": cfg.parallel_jobs, "heavy_share": cfg.heavy_share, "bloom": cfg.bloom}
    for full in build(lake, GOLD_TABLES, cfg.as_of, cfg.run_ts, resume=resume, **how):
        tables[full.split(".")[1]] = full
    marts = {t: lake.ref("gold", t) for t in GOLD_TABLES}
    doc = context.snapshot(
        marts["dim_clients"], lake.ref("silver", "stg_seo_rankings"), marts["fct_ad_performance"], cfg.as_of, cfg.run_ts
    )
    tables["client_context"] = lake.write(doc, "gold", "client_context", cluster_by="client_id")
    bronze = {t: lake.ref("bronze", t) for t in cfg.raw}
    tests = (
        quality.bronze_tests(bronze, cfg.run_ts, cfg.two_pass_unique).unionByName(
            quality.mart_tests(marts, cfg.two_pass_unique)
        )  # one pass over each table
    )
    tables["test_results"] = lake.write(tests, "quality", "test_results")
    if cfg.gate == "raise":
        C.gate(lake.ref("quality", "test_results"))
    return tables


# Key whose sum goes with a table's row count: integers as they are, md5 keys by their first 8 digits.
SUM_KEYS = {
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


def published_sums(spark: SparkSession, tables: Mapping[str, str]) -> DataFrame:
    """``table_name, row_count, key_sum`` of the data tables of a run."""
    parts = []
    for t, key in SUM_KEYS.items():
        if t in tables:
            value = f"CAST(conv(substr({key}, 1, 8), 16, 10) AS BIGINT)" if key.endswith("_key") else f"CAST({key} AS BIGINT)"
            parts.append(
                spark.table(tables[t]).selectExpr(f"'{t}' AS table_name", "count(1) AS row_count", f"sum({value}) AS key_sum")
            )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def published_counts(spark: SparkSession, tables: Mapping[str, str]) -> DataFrame:
    """``table_name, row_count`` of the 14 data tables of a run."""
    names = [tables[t] for t in (*RAW_TABLES, *SILVER_TABLES, *GOLD_TABLES) if t in tables]
    return row_counts(spark, names)
