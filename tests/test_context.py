import json
from datetime import date, datetime
from decimal import Decimal

from lakeops.plans import context

AS_OF = date(2024, 2, 10)
RUN_TS = datetime(2024, 2, 10)

DIM = "client_id int, client_name string, industry string, plan_tier string, days_active bigint, total_leads bigint, converted_leads bigint, lead_conversion_rate double, total_appointments bigint"
SEO = "client_id int, keyword string, position int, snapshot_date date"
PERF = "client_id int, spend_date date, spend decimal(10,2), cpl double"


def dim(spark):
    return spark.createDataFrame(
        [(1, "One", "legal", "pro", 10, 4, 1, 0.25, 2), (2, "Two", "auto", "pro", 5, 0, 0, None, 0)], DIM
    )


def seo(spark):
    rows = [(1, f"kw{i}", p, date(2024, 1, 1)) for i, p in enumerate([9, 3, 7, 3, 1, 50, 2])]
    rows.append((1, "kw4", 1, date(2024, 1, 8)))  # same keyword, newer snapshot
    return spark.createDataFrame(rows, SEO)


def perf(spark):
    return spark.createDataFrame(
        [
            (1, date(2024, 1, 11), Decimal("10.00"), 2.0),  # exactly 30 days back: in
            (1, date(2024, 1, 10), Decimal("99.00"), 9.0),  # 31 days back: out
            (1, date(2024, 3, 1), Decimal("5.50"), None),  # future: in (no upper bound)
        ],
        PERF,
    )


def test_top_keywords_rank_order_and_repeats(spark):
    got = [(r.rank, r.keyword, r.position) for r in context.top_keywords(seo(spark)).orderBy("rank").collect()]
    assert got == [(1, "kw4", 1), (2, "kw4", 1), (3, "kw6", 2), (4, "kw1", 3), (5, "kw3", 3)]


def test_trailing_spend_window_bounds(spark):
    r = context.trailing_spend(perf(spark), AS_OF).first()
    assert r.monthly_spend_usd == 15.5 and r.avg_cpl == 2.0


def test_snapshot_defaults_and_order(spark):
    docs = {r.client_id: r for r in context.snapshot(dim(spark), seo(spark), perf(spark), AS_OF, RUN_TS).collect()}
    assert docs[2].top_keywords == [] and docs[2].monthly_spend_usd == 0.0 and docs[2].avg_cpl is None
    assert [k.keyword for k in docs[1].top_keywords] == ["kw4", "kw4", "kw6", "kw1", "kw3"]
    assert docs[1].last_updated == "2024-02-10T00:00:00+00:00"


def test_snapshot_json_keeps_nulls_and_field_order(spark):
    doc = context.snapshot(dim(spark), seo(spark), perf(spark), AS_OF, RUN_TS)
    js = {r.client_id: r.context_json for r in context.snapshot_json(doc).collect()}
    two = json.loads(js[2])
    assert list(two) == list(context.DOCUMENT_FIELDS)
    assert two["avg_cpl"] is None and two["top_keywords"] == []
    assert json.loads(js[1])["top_keywords"][0] == {"keyword": "kw4", "position": 1}


def test_unknown_client_gives_no_row(spark):
    doc = context.snapshot(dim(spark), seo(spark), perf(spark), AS_OF, RUN_TS, client_id=42)
    assert doc.count() == 0


def test_point_lookup_filter_reaches_parquet_scan(spark, tmpdir_path):
    path = f"{tmpdir_path}/dim"
    dim(spark).write.parquet(path)
    q = context.client_metrics(spark.read.parquet(path), client_id=1)
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(client_id), EqualTo(client_id,1)]" in plan
    assert q.count() == 1
