"""Re-delivered files and incremental Silver."""

import os
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lakeops.plans import incremental, silver
from lakeops.session import shared_path
from lakeops.sources import landing as L
from lakeops.sources.bronze import Lake

RUN_TS = datetime(2024, 2, 10)
HEADER = "client_id,channel,date,spend,impressions,clicks\n"


@pytest.fixture
def lake(spark):
    return Lake(spark, shared_path(spark, "landing", unique=True))


def put(folder, name, *rows, header=HEADER):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(header + "".join(r + "\n" for r in rows))
    later = time.time() + put.count  # each delivery has a time of its own
    put.count += 1
    os.utime(path, (later, later))


put.count = 1


def held(lake, *columns):
    return sorted(map(tuple, lake.ref("bronze", "raw_ad_spend").select(*(columns or ("_drop", "client_id", "clicks"))).collect()))


def days(lake):
    return {r["spend_date"].isoformat(): (r["n"], r["c"]) for r in lake.ref("silver", "stg_ad_spend").groupBy("spend_date")
            .agg(F.count("*").alias("n"), F.sum("clicks").alias("c")).collect()}


def names(lake):
    rows = lake.ref("silver", "stg_ad_spend").select("_region", "_metadata.file_name").distinct().collect()
    return {r["_region"]: r["file_name"] for r in rows}


def test_a_rewritten_file_replaces_its_rows(spark, lake, tmp_path):
    put(tmp_path, "a.csv", "1,google,2024-01-01,1.5,10,1", "2,meta,2024-01-02,1.5,10,2")
    put(tmp_path, "b.csv", "3,google,2024-01-03,1.5,10,3")
    put(tmp_path, "c d/x.csv", "4,google,2024-01-03,1.5,10,4")
    put(tmp_path, "c d/y.csv", "5,google,2024-01-04,1.5,10,5")
    got = incremental.ingest_ad_spend(lake, str(tmp_path), RUN_TS)
    assert got.drops == ["a.csv", "b.csv", "c d"] and got.touched == [f"2024-01-0{d}" for d in (1, 2, 3, 4)]
    assert held(lake) == [("a.csv", 1, 1), ("a.csv", 2, 2), ("b.csv", 3, 3), ("c d", 4, 4), ("c d", 5, 5)]
    assert incremental.ingest_ad_spend(lake, str(tmp_path), RUN_TS) == L.Ingest()  # nothing new
    before = names(lake)
    put(tmp_path, "a.csv", "1,google,2024-01-01,1.5,10,100")  # without the row of 2024-01-02
    put(tmp_path, "new.csv", "6,google,2024-01-01,1.5,10,6")
    got = incremental.ingest_ad_spend(lake, str(tmp_path), RUN_TS)
    assert got.drops == ["a.csv", "new.csv"] and got.touched == ["2024-01-01", "2024-01-02"]
    assert held(lake) == [("a.csv", 1, 100), ("b.csv", 3, 3), ("c d", 4, 4), ("c d", 5, 5), ("new.csv", 6, 6)]
    assert days(lake) == {"2024-01-01": (2, 106), "2024-01-03": (2, 7), "2024-01-04": (1, 5)}
    after = names(lake)
    assert {d: after[d] for d in ("2024-01-03", "2024-01-04")} == {d: before[d] for d in ("2024-01-03", "2024-01-04")}
    put(tmp_path, "a.csv")  # no rows any more
    assert incremental.ingest_ad_spend(lake, str(tmp_path), RUN_TS).drops == ["a.csv"]
    assert held(lake, "client_id") == [(3,), (4,), (5,), (6,)]
    full = silver.stg_ad_spend(lake.ref("bronze", "raw_ad_spend"), RUN_TS)
    made = lake.ref("silver", "stg_ad_spend").drop("_region")
    assert full.exceptAll(made).count() == 0 and made.exceptAll(full).count() == 0


def test_a_crash_before_the_cursor_is_repeated(spark, lake, tmp_path, monkeypatch):
    put(tmp_path, "a.csv", "1,google,2024-01-01,1.5,10,1")
    with monkeypatch.context() as m:
        m.setattr(Lake, "write", lambda self, df, layer, name, *a, **k: (_ for _ in ()).throw(RuntimeError("crash")) if name.endswith("_drops") else WRITE(self, df, layer, name, *a, **k))
        with pytest.raises(RuntimeError, match="crash"):
            L.ingest_drops(lake, str(tmp_path), run_ts=RUN_TS)
    assert held(lake) == [("a.csv", 1, 1)]
    assert L.ingest_drops(lake, str(tmp_path), run_ts=RUN_TS).drops == ["a.csv"]
    assert held(lake) == [("a.csv", 1, 1)]


WRITE = Lake.write


def test_bad_landings(spark, lake, tmp_path):
    with pytest.raises(FileNotFoundError):
        L.ingest_drops(lake, str(tmp_path / "none"), run_ts=RUN_TS)
    assert L.ingest_drops(lake, str(tmp_path), run_ts=RUN_TS) == L.Ingest()
    put(tmp_path, "a.csv", "1,google", header="client_id,channel\n")
    with pytest.raises(ValueError, match="no column date"):
        L.ingest_drops(lake, str(tmp_path), run_ts=RUN_TS)
    put(tmp_path, "a.csv", "x,google,2024-01-01,1.5,10,1")
    with pytest.raises(Exception, match="(?i)malformed|for input string|cannot"):
        L.ingest_drops(lake, str(tmp_path), run_ts=RUN_TS)
    put(tmp_path, "a.csv", "1,google,2024-01-01,1.5,10,1")
    assert L.ingest_drops(lake, str(tmp_path), run_ts=RUN_TS).drops == ["a.csv"]


def test_buckets_merge_as_a_full_build_and_leave_others_alone(spark, lake):
    def leads(rows):
        df = spark.createDataFrame(rows, "id int, client_id int, source string, status string, value double, at string")
        return df.selectExpr(*df.columns[:5], "TIMESTAMP_NTZ '2024-01-01' AS created_at", "CAST(at AS TIMESTAMP_NTZ) AS _loaded_at")

    raw, own = (incremental.by_bucket(c, buckets=8) for c in ("CAST(id AS INT)", "lead_id"))
    first = leads([(i, 1, "Web", "New", 1.0, "2024-01-01") for i in range(40)] + [(None, 1, "Web", "New", 1.0, "2024-01-01")])
    tied = leads([(3, 1, "Web", s, 2.0, "2024-01-05") for s in ("Lost", "New", "Won")])  # the total order decides
    older = leads([(4, 9, "Web", "Old", 1.0, "2023-01-01"), (3, 1, "Web", "Zed", 1.0, "2023-01-01"), (99, 1, "Ad", "New", 1.0, "2024-01-01")])
    seen, names = None, []
    for drop in (first, tied, older):
        regions = incremental.land(lake, drop, "raw_leads", raw)
        incremental.refresh(lake, lake.ref("bronze", "raw_leads"), "stg_leads", silver.stg_leads, regions, own)
        seen = drop if seen is None else seen.unionByName(drop)
        full, made = silver.stg_leads(seen), lake.ref("silver", "stg_leads").drop("_region")
        assert full.exceptAll(made).count() == 0 and made.exceptAll(full).count() == 0
        rows = lake.ref("silver", "stg_leads").select("_region", "_metadata.file_name").distinct().collect()
        names.append({r[0]: r[1] for r in rows})
        if len(names) > 1:
            kept = {r for r, n in names[-1].items() if names[-2].get(r) == n}
            assert kept == set(names[-2]) - set(regions) and kept
    assert lake.ref("silver", "stg_leads").where("lead_id = 3").first()["lead_status"] == "won"
