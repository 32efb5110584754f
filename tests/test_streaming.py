import os
import time

import pytest

from datetime import datetime

from pyspark.sql import functions as F

from lakeops.plans import silver
from lakeops.sources.files import AD_SPEND_SCHEMA
from lakeops.streaming import ingest_new_csv, land_csv

RUN_TS = datetime(2024, 2, 10)


def test_only_new_files_are_ingested_and_resent_keys_win(spark, tmpdir_path):
    landing, table, ckpt = f"{tmpdir_path}/landing", f"{tmpdir_path}/table", f"{tmpdir_path}/ckpt"
    first = spark.createDataFrame(
        [(1, "google", "2024-01-01", 1.0, 10, 1), (1, "meta", "2024-01-01", 2.0, 10, 1)], AD_SPEND_SCHEMA
    )
    land_csv(first, landing)
    ingest_new_csv(spark, landing, table, ckpt)
    assert spark.read.parquet(table).count() == 2
    ingest_new_csv(spark, landing, table, ckpt)  # nothing new
    assert spark.read.parquet(table).count() == 2
    resent = spark.createDataFrame([(1, "google", "2024-01-01", 9.0, 10, 1)], AD_SPEND_SCHEMA)
    land_csv(resent, landing)
    ingest_new_csv(spark, landing, table, ckpt)
    raw = spark.read.parquet(table)
    assert raw.count() == 3 and raw.where(F.col("_dlt_load_time").isNull()).count() == 0
    stg = {r.channel: float(r.spend) for r in silver.stg_ad_spend(raw, RUN_TS).collect()}
    assert stg == {"google": 9.0, "meta": 2.0}  # the later batch stamp wins the dedup


def test_processed_files_are_archived(spark, tmpdir_path):
    import glob

    landing, table, ckpt, archive = (f"{tmpdir_path}/{n}" for n in ("landing", "table", "ckpt", "archive"))
    rows = spark.createDataFrame([(2, "email", "2024-01-02", 1.5, 10, 1)], AD_SPEND_SCHEMA)
    land_csv(rows, landing)
    ingest_new_csv(spark, landing, table, ckpt, archive_dir=archive, max_files_per_batch=1)
    land_csv(rows, landing)  # a second drop; its arrival makes the first batch's files eligible for archiving
    ingest_new_csv(spark, landing, table, ckpt, archive_dir=archive, max_files_per_batch=1)
    assert spark.read.parquet(table).count() == 2
    assert glob.glob(f"{archive}/**/*.csv", recursive=True)


def test_old_dated_file_after_a_new_one_is_ingested(spark, tmpdir_path):
    landing, table, ckpt = (f"{tmpdir_path}/{x}" for x in ("age", "age_table", "age_ckpt"))
    os.makedirs(landing)
    header = "client_id,channel,date,spend,impressions,clicks\n"
    for name, days in (("new.csv", 0), ("old.csv", 20)):
        path = f"{landing}/{name}"
        with open(path, "w") as f:
            f.write(header + "1,google,2024-01-01,1.0,10,1\n")
        then = time.time() - days * 86400
        os.utime(path, (then, then))
        ingest_new_csv(spark, landing, table, ckpt)
    assert spark.read.parquet(table).count() == 2


def test_file_with_another_header_stops_the_stream(spark, tmpdir_path):
    landing = f"{tmpdir_path}/other"
    os.makedirs(landing)
    with open(f"{landing}/a.csv", "w") as f:
        f.write("client_id,date,channel,spend,clicks,impressions\n1,2024-01-01,google,1.0,1,10\n")
    with pytest.raises(Exception):
        ingest_new_csv(spark, landing, f"{tmpdir_path}/t", f"{tmpdir_path}/c")
