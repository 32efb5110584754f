"""Command line: the full run, the quality gate, freshness, and a context lookup.

    python -m lakeops pipeline --root PATH (--testdata SF_DIR | --jdbc-url URL --seo-json F --ad-spend-csv F)
    python -m lakeops quality  --root PATH
    python -m lakeops freshness --root PATH
    python -m lakeops context  --root PATH --client-id N

``--root`` is the shared folder of the Bronze/Silver/Gold tables. ``--as-of``
and ``--run-ts`` default to the clock, read once here and passed to the models.
"""

from __future__ import annotations

import argparse
import json
import os
import sys
from datetime import date, datetime, timezone

from pyspark.sql import SparkSession


def _session() -> SparkSession:
    """The launcher's session; the web UI stays off unless the launcher turns it on."""
    from pyspark import SparkConf

    from lakeops.session import configure

    builder = SparkSession.builder.appName("lakeops")
    if not SparkConf().contains("spark.ui.enabled"):
        builder = builder.config("spark.ui.enabled", "false")
    return configure(builder.getOrCreate())


def _clock(args) -> tuple[date, datetime]:
    run_ts = datetime.fromisoformat(args.run_ts) if args.run_ts else datetime.now(timezone.utc).replace(tzinfo=None)
    as_of = date.fromisoformat(args.as_of) if args.as_of else run_ts.date()
    return as_of, run_ts


def cmd_pipeline(args) -> int:
    from lakeops.operators.checks import QualityGateFailed
    from lakeops.plans import pipeline
    from lakeops.sources import bindings
    from lakeops.sources.raw import raw_from_sources

    spark = _session()
    as_of, run_ts = _clock(args)
    if args.testdata:
        raw = bindings.raw_tables(spark, args.testdata, run_ts)
    else:
        props = {}
        if args.jdbc_user:
            props["user"] = args.jdbc_user
        if args.jdbc_password_env:
            props["password"] = os.environ[args.jdbc_password_env]
        raw = raw_from_sources(spark, run_ts, args.jdbc_url, props, args.jdbc_parts, None, args.seo_json,
                               args.seo_json_lines, args.ad_spend_csv)
    cfg = pipeline.PipelineConfig(root=args.root, as_of=as_of, run_ts=run_ts, raw=raw, gate=args.gate)
    try:
        tables = pipeline.run_all(spark, cfg)
    except QualityGateFailed as e:
        print(e, file=sys.stderr)
        return 1
    for r in pipeline.published_counts(spark, tables).collect():
        print(f"{r.table_name:22s} {r.row_count}")
    return 0


def cmd_quality(args) -> int:
    from lakeops.operators import checks as C
    from lakeops.plans import quality
    from lakeops.sources.bronze import Lake

    spark = _session()
    lake = Lake(spark, args.root)
    tables = {t: lake.ref("silver", t) for t in ("stg_clients", "stg_leads")}
    results = C.run_many(tables, {"stg_clients": quality.suite_checks(quality.SUITE_CLIENTS),
                                  "stg_leads": quality.suite_checks(quality.SUITE_LEADS)})
    try:
        C.gate(results)
    except C.QualityGateFailed as e:
        print(e, file=sys.stderr)
        return 1
    print("data quality gate passed")
    return 0


def cmd_freshness(args) -> int:
    from lakeops.plans import quality
    from lakeops.sources.bronze import Lake

    spark = _session()
    results = quality.from_footers(Lake(spark, args.root), quality.published_state(_clock(args)[1]))
    rows = results.collect()  # one per declared check
    for r in rows:
        print(f"{r.table_name:22s} {r.check:18s} {'ok' if r.success else 'FAILED':6s} {r.detail or ''} {r.observed}")
    return 0 if all(r.success for r in rows) else 1


def cmd_context(args) -> int:
    from lakeops.plans import context
    from lakeops.sources.bronze import Lake

    spark = _session()
    published = Lake(spark, args.root).ref("gold", "client_context")
    docs = context.snapshot_json(context.lookup(published, args.client_id))
    rows = docs.collect()  # at most one row: the client asked for
    if not rows:
        print(f"client {args.client_id} not found", file=sys.stderr)
        return 2
    print(json.dumps(json.loads(rows[0].context_json), indent=2))
    return 0


def main(argv=None) -> int:
    p = argparse.ArgumentParser(prog="lakeops")
    sub = p.add_subparsers(dest="cmd", required=True)
    pl = sub.add_parser("pipeline", help="Bronze -> Silver -> gate -> Gold -> tests")
    pl.add_argument("--root", required=True)
    pl.add_argument("--testdata", help="bind the test tables in this folder as raw sources")
    pl.add_argument("--jdbc-url")
    pl.add_argument("--jdbc-user")
    pl.add_argument("--jdbc-password-env", help="name of the environment variable holding the password")
    pl.add_argument("--jdbc-parts", type=int, default=1)
    pl.add_argument("--seo-json")
    pl.add_argument("--seo-json-lines", action="store_true", help="the SEO file is JSON Lines")
    pl.add_argument("--ad-spend-csv")
    pl.add_argument("--gate", choices=("raise", "record"), default="raise")
    pl.add_argument("--as-of")
    pl.add_argument("--run-ts")
    pl.set_defaults(fn=cmd_pipeline)
    q = sub.add_parser("quality", help="run the expectation suites on published Silver and gate")
    q.add_argument("--root", required=True)
    q.set_defaults(fn=cmd_quality)
    f = sub.add_parser("freshness", help="freshness and row counts of the published tables, from file footers")
    f.add_argument("--root", required=True)
    f.add_argument("--as-of")
    f.add_argument("--run-ts")
    f.set_defaults(fn=cmd_freshness)
    c = sub.add_parser("context", help="print the context document of one client")
    c.add_argument("--root", required=True)
    c.add_argument("--client-id", type=int, required=True)
    c.set_defaults(fn=cmd_context)
    args = p.parse_args(argv)
    return args.fn(args)


if __name__ == "__main__":
    sys.exit(main())
