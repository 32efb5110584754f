from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from lakeops.operators import checks as C
from lakeops.operators.contracts import Contract, ContractViolation, contract_report, enforce
from lakeops.plans import quality

NOW = datetime(2024, 2, 10)


def results(df):
    return {(r.table_name, r.check, r.column_name): r for r in df.collect()}


def test_contract_violation_before_write(spark):
    contract = Contract.of("t", [("a", "integer", True), ("b", "varchar", False)])
    bad = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(ContractViolation) as e:
        enforce(bad, contract)
    assert ("b", "varchar", None, "missing") in e.value.problems
    wrong = spark.createDataFrame([(1, "x")], "a bigint, b string")
    with pytest.raises(ContractViolation):
        enforce(wrong, contract)


def test_not_null_constraint_fails_the_write_plan(spark, tmpdir_path):
    contract = Contract.of("t", [("a", "integer", True), ("b", "varchar", False)])
    df = spark.createDataFrame([(1, "x"), (None, "y")], "a int, b string")
    out = enforce(df, contract)
    with pytest.raises(Exception) as e:
        out.write.parquet(f"{tmpdir_path}/t")
    assert "NOT NULL constraint failed: t.a" in str(e.value)
    ok = enforce(spark.createDataFrame([(2, None)], "a int, b string"), contract)
    assert ok.collect()[0].a == 2


def test_contract_report_lists_types_and_nulls(spark):
    contract = Contract.of("t", [("a", "integer", True), ("b", "varchar", False), ("c", "double", False)])
    df = spark.createDataFrame([(1, None, 5), (None, "y", 6)], "a int, b string, d int")
    rows = {r.column_name: r for r in contract_report(df, contract).collect()}
    assert rows["a"].issue == "ok" and rows["a"].null_rows == 1 and rows["a"].not_null
    assert rows["c"].issue == "missing" and rows["c"].null_rows is None
    assert rows["d"].issue == "extra" and rows["d"].actual_type == "integer"


def test_checks_semantics(spark):
    df = spark.createDataFrame(
        [(1, "a", 5.0), (1, "b", None), (2, None, 20.0), (None, "zz", 1.0)], "k int, s string, v double"
    )
    res = results(
        C.run_checks(
            df,
            "t",
            [
                C.not_null("k"),
                C.unique("k"),
                C.accepted_values("s", ["a", "b"]),
                C.between("v", 0, 10),
                C.row_count_between(1, 4),
                C.row_count_near(5, 0.25),
                C.row_count_near(5, 0.2),
                C.has_columns(["k", "zz", "s", "aa"]),
            ],
        )
    )
    assert res[("t", "not_null", "k")].unexpected == 1
    u = res[("t", "unique", "k")]
    assert (u.success, u.observed, u.unexpected) == (False, 3, 2)  # NULL ignored
    av = res[("t", "accepted_values", "s")]
    assert (av.success, av.unexpected) == (False, 1)  # NULL passes, 'zz' fails
    b = res[("t", "between", "v")]
    assert (b.success, b.observed, b.unexpected) == (False, 3, 1)
    assert res[("t", "row_count_between", None)].success
    near = [r for r in C.run_checks(df, "t", [C.row_count_near(5, 0.25), C.row_count_near(5, 0.2)]).collect()]
    assert sorted(r.success for r in near) == [False, True]  # |4-5|/5 = 0.2 is not < 0.2
    hc = res[("t", "has_columns", None)]
    assert (hc.success, hc.observed, hc.unexpected, hc.detail) == (False, 2, 2, "aa,zz")


def test_relationship_counts_orphan_rows(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (3,), (None,)], "p int")
    parent = spark.createDataFrame([(1,), (2,)], "id int")
    r = C.run_checks(child, "c", [C.relationship("p", parent, "id", "parent")]).first()
    assert (r.success, r.observed, r.unexpected, r.detail) == (False, 4, 1, "parent.id")


def test_freshness_states(spark):
    df = spark.createDataFrame(
        [(NOW - timedelta(hours=30),)], "ts timestamp_ntz"
    )
    checks = [
        C.freshness("ts", timedelta(hours=25), timedelta(hours=48), NOW),
        C.freshness("ts", timedelta(hours=31), timedelta(hours=48), NOW),
        C.freshness("ts", timedelta(hours=1), timedelta(hours=2), NOW),
        C.staleness("ts", timedelta(hours=30), NOW),
    ]
    got = [(r.detail, r.success, r.observed) for r in C.run_checks(df, "t", checks).collect()]
    assert got == [("warn", True, 108000), ("pass", True, 108000), ("error", False, 108000), ("fresh", True, 108000)]


def test_empty_table_freshness_is_error(spark):
    df = spark.createDataFrame([], "ts timestamp_ntz")
    r = C.run_checks(df, "t", [C.freshness("ts", timedelta(hours=1), timedelta(hours=2), NOW)]).first()
    assert r.detail == "error" and not r.success


def test_suite_from_expectation_json(spark):
    df = spark.createDataFrame(
        [(i, "legal", "pro", "2024-01-01") for i in range(3)], "client_id int, industry string, plan_tier string, onboard_date string"
    )
    res = quality.run_suite(df, "stg_clients", quality.SUITE_CLIENTS).collect()
    assert len(res) == 6
    failed = [r.check for r in res if not r.success]
    assert failed == ["row_count_between"]  # 3 rows, not 490..510


def test_gate_raises_with_failures_and_passes_clean(spark):
    df = spark.createDataFrame([(1,), (None,)], "k int")
    with pytest.raises(C.QualityGateFailed) as e:
        C.gate(C.run_checks(df, "t", [C.not_null("k"), C.row_count_between(1, 5)]))
    assert len(e.value.failures) == 1 and e.value.failures[0]["check"] == "not_null"
    ok = C.run_checks(df.where(F.col("k").isNotNull()), "t", [C.not_null("k")])
    assert C.gate(ok) is ok


def test_declared_test_sets_have_reference_sizes():
    assert len(quality.SOURCE_TESTS) == 27
    assert len(quality.MART_TESTS) == 34
    assert sum(len(s["expectations"]) for s in (quality.SUITE_CLIENTS, quality.SUITE_LEADS)) == 13


def test_all_checks_of_a_table_share_one_scan(spark, tmpdir_path):
    path = f"{tmpdir_path}/t"
    spark.createDataFrame([(1, "a"), (1, "b"), (2, None)], "k int, s string").write.parquet(path)
    df = spark.read.parquet(path)
    checks = [C.not_null("k"), C.unique("k"), C.unique("s"), C.accepted_values("s", ["a"]), C.row_count_between(1, 2)]
    out = C.run_checks(df, "t", checks)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
    res = results(out)
    assert res[("t", "unique", "k")].unexpected == 2 and res[("t", "unique", "s")].unexpected == 0
    assert not res[("t", "row_count_between", None)].success


def test_empty_table_still_reports_every_check(spark):
    df = spark.createDataFrame([], "k int")
    res = C.run_checks(df, "t", [C.not_null("k"), C.unique("k"), C.row_count_between(1, None)]).collect()
    assert len(res) == 3
    assert {r.check: r.success for r in res} == {"not_null": True, "unique": True, "row_count_between": False}
