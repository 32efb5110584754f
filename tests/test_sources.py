import glob
import json
import os

import pytest

from lakeops.sources import Lake, read_csv_typed, read_json_array, read_jdbc, write_bronze
from lakeops.sources.files import AD_SPEND_SCHEMA


def test_csv_typed_reads_and_fails_fast(spark, tmpdir_path):
    good = os.path.join(tmpdir_path, "good.csv")
    with open(good, "w") as f:
        f.write("client_id,channel,date,spend,impressions,clicks\n1,google,2023-01-01,187.43,20952,391\n")
    r = read_csv_typed(spark, good).first()
    assert (r.client_id, r.spend, r.clicks) == (1, 187.43, 391)
    bad = os.path.join(tmpdir_path, "bad.csv")
    with open(bad, "w") as f:
        f.write("client_id,channel,date,spend,impressions,clicks\n1,google,2023-01-01,1.0,abc,3\n")
    with pytest.raises(Exception) as e:
        read_csv_typed(spark, bad).collect()
    assert "FAILFAST" in str(e.value) or "Malformed" in str(e.value)


def test_missing_input_is_file_not_found(spark, tmpdir_path):
    with pytest.raises(FileNotFoundError):
        read_csv_typed(spark, os.path.join(tmpdir_path, "nope.csv"))
    with pytest.raises(FileNotFoundError):
        read_json_array(spark, os.path.join(tmpdir_path, "nope.json"))


def test_json_array_file(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "seo.json")
    rows = [{"client_id": 1, "keyword": "legal near me", "position": 42, "snapshot_date": "2023-01-02"},
            {"client_id": 2, "keyword": "dentist", "position": 3, "snapshot_date": "2023-01-09"}]
    with open(path, "w") as f:
        json.dump(rows, f, indent=2)
    got = sorted((r.client_id, r.keyword, r.position) for r in read_json_array(spark, path).collect())
    assert got == [(1, "legal near me", 42), (2, "dentist", 3)]


def test_json_lines_form_is_split(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "seo.jsonl")
    with open(path, "w") as f:
        for i in range(2000):
            f.write(json.dumps({"client_id": i % 7, "keyword": f"kw {i}", "position": i % 100 + 1, "snapshot_date": "2023-01-02"}) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        df = read_json_array(spark, path, json_lines=True)
        assert df.rdd.getNumPartitions() > 1
        assert df.count() == 2000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_bronze_replace_and_named_read(spark, tmpdir_path):
    lake = Lake(spark, f"{tmpdir_path}/lake")
    df = spark.createDataFrame([(1, "google", "2024-01-01", 1.0, 1, 1)], AD_SPEND_SCHEMA)
    from datetime import datetime

    write_bronze(lake, df, "raw_ad_spend", partition_by=("date",), load_col="_dlt_load_time", run_ts=datetime(2024, 2, 1))
    write_bronze(lake, df.union(df), "raw_ad_spend", partition_by=("date",), load_col="_dlt_load_time", run_ts=datetime(2024, 2, 1))
    back = lake.ref("bronze", "raw_ad_spend")
    assert back.count() == 2  # replaced, not appended
    assert back.first()._dlt_load_time == datetime(2024, 2, 1)
    assert len(glob.glob(f"{tmpdir_path}/lake/bronze/raw_ad_spend/v-*/date=2024-01-01")) == 2  # a folder per version
    plan = back.where("date = '2024-01-01'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan


class _RecordingReader:
    """Stands in for ``spark.read``: records the JDBC options instead of connecting."""

    def __init__(self):
        self.fmt, self.options = None, {}

    def format(self, fmt):
        self.fmt = fmt
        return self

    def option(self, key, value):
        self.options[key] = value
        return self

    def load(self):
        return self


class _StubSession:
    def __init__(self):
        self.read = _RecordingReader()


def test_jdbc_scan_is_split_into_key_ranges():
    # No database is started in this environment; the reader's wiring is checked instead.
    s = _StubSession()
    r = read_jdbc(s, "jdbc:postgresql://db/app", "leads", key="id", bounds=(1, 1_000_000), parts=64,
                  properties={"user": "u", "fetchsize": "10000"})
    assert r.fmt == "jdbc"
    assert r.options == {
        "url": "jdbc:postgresql://db/app", "dbtable": "leads", "user": "u", "fetchsize": "10000",
        "partitionColumn": "id", "lowerBound": "1", "upperBound": "1000000", "numPartitions": "64",
    }
    whole = read_jdbc(_StubSession(), "jdbc:postgresql://db/app", "clients")
    assert "partitionColumn" not in whole.options


def test_raw_tables_from_files_are_stamped(spark, tmpdir_path):
    from datetime import datetime

    from lakeops.plans import silver
    from lakeops.sources.raw import raw_from_sources

    seo = os.path.join(tmpdir_path, "seo.json")
    with open(seo, "w") as f:
        json.dump([{"client_id": 1, "keyword": "legal near me", "position": 42, "snapshot_date": "2023-01-02"}], f)
    ads = os.path.join(tmpdir_path, "ads.csv")
    with open(ads, "w") as f:
        f.write("client_id,channel,date,spend,impressions,clicks\n1,google,2023-01-01,187.43,20952,391\n")
    run_ts = datetime(2024, 2, 10)
    raw = raw_from_sources(spark, run_ts, seo_json=seo, ad_spend_csv=ads)
    assert set(raw) == {"raw_seo_rankings", "raw_ad_spend"}
    assert raw["raw_ad_spend"].first()._dlt_load_time == run_ts
    r = silver.stg_ad_spend(raw["raw_ad_spend"], run_ts).first()
    assert (r.client_id, str(r.spend), r.clicks) == (1, "187.43", 391)
    assert silver.stg_seo_rankings(raw["raw_seo_rankings"], run_ts).first().position == 42


def test_cli_context_lookup(spark, tmpdir_path, capsys):
    from lakeops import cli

    root = f"{tmpdir_path}/lake"
    spark.createDataFrame(
        [(7, "Seven", "legal", "pro", 3, 2, 1, 0.5, 1, [("kw", 2)], 10.0, None, "2024-02-10T00:00:00+00:00")],
        "client_id int, client_name string, industry string, plan_tier string, days_active bigint, total_leads bigint, "
        "converted_leads bigint, lead_conversion_rate double, total_appointments bigint, "
        "top_keywords array<struct<keyword:string,position:int>>, monthly_spend_usd double, avg_cpl double, last_updated string",
    ).write.parquet(f"{root}/gold/client_context")
    assert cli.main(["context", "--root", root, "--client-id", "7"]) == 0
    doc = json.loads(capsys.readouterr().out)
    assert doc["client_name"] == "Seven" and doc["avg_cpl"] is None and doc["top_keywords"] == [{"keyword": "kw", "position": 2}]
    assert cli.main(["context", "--root", root, "--client-id", "8"]) == 2


def test_csv_is_read_by_name(spark, tmpdir_path):
    path = f"{tmpdir_path}/permuted.csv"
    with open(path, "w") as f:
        f.write("note,clicks,date,channel,client_id,spend,impressions\nx,1,2024-01-01,google,7,2.5,10\n")
    row = read_csv_typed(spark, path).first()
    assert tuple(row) == (7, "google", "2024-01-01", 2.5, 10, 1)


def test_csv_without_a_column_is_an_error(spark, tmpdir_path):
    path = f"{tmpdir_path}/short.csv"
    with open(path, "w") as f:
        f.write("client_id,channel,date,spend,clicks\n7,google,2024-01-01,2.5,1\n")
    with pytest.raises(ValueError, match="impressions"):
        read_csv_typed(spark, path)


def test_jdbc_parts_need_bounds():
    with pytest.raises(ValueError):
        read_jdbc(_StubSession(), "jdbc:postgresql://db/app", "leads", parts=8)


def test_ansi_is_forced(spark):
    from lakeops.session import configure

    spark.conf.set("spark.sql.ansi.enabled", "false")
    configure(spark)
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"


def test_appointments_carry_small_numbers_through_their_join(spark, tmpdir_path):
    from datetime import datetime

    from lakeops.sources import bindings as B

    ship = datetime(2024, 1, 20, 5)
    orders = [(1, 7, datetime(1995, 1, 4)), (2, 8, datetime(1995, 2, 1)), (3, None, None), (None, 9, datetime(1995, 1, 1))]
    lines = [(1, 30, 1, "N", "O", ship), (2, None, 2, "A", "F", None), (3, 5, 1, None, None, ship), (9, 1, 1, "R", "F", ship), (None, 1, 1, "R", "F", ship)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz").write.parquet(f"{tmpdir_path}/orders.parquet")
    spark.createDataFrame(
        lines, "l_orderkey long, l_partkey long, l_linenumber int, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ).write.parquet(f"{tmpdir_path}/lineitem.parquet")
    raw = B.raw_appointments(spark, tmpdir_path)
    got = {r.id: (r.lead_id, r.client_id, r.scheduled_at, r.status, r.notes, r._loaded_at) for r in raw.collect()}
    assert got == {
        9: (1, -7, datetime(2024, 1, 7), "Scheduled", "O", ship),  # 3 days, 30 % 14 = 2, and one
        18: (2, 8, None, "Completed", "F", None),
        25: (3, None, None, None, None, ship),
    }
    join = raw._jdf.queryExecution().optimizedPlan().toString().split("Join Inner")[1]
    assert "AS part_day" in join and "AS order_day" in join
