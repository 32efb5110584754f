import hashlib
from datetime import datetime

from pyspark.sql import functions as F

from lakeops.functions import NULL_PLACEHOLDER, days_between, flag, safe_ratio, surrogate_key, zero_fill
from lakeops.functions.keys import light_key_sql, whole_key_sql


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def test_surrogate_key_single_and_composite(spark):
    df = spark.createDataFrame([(1, "Google", "2024-01-01"), (2, None, "2024-01-02")], "id long, ch string, d string")
    got = {r.id: (r.k1, r.k3) for r in df.select("id", surrogate_key("id").alias("k1"),
                                                  surrogate_key("id", "ch", "d").alias("k3")).collect()}
    assert got[1] == (md5("1"), md5("1-Google-2024-01-01"))
    assert got[2] == (md5("2"), md5(f"2-{NULL_PLACEHOLDER}-2024-01-02"))


def test_surrogate_key_never_null(spark):
    df = spark.createDataFrame([(None,)], "id long")
    assert df.select(surrogate_key("id").alias("k")).first().k == md5(NULL_PLACEHOLDER)


def test_safe_ratio_zero_and_null_denominators(spark):
    df = spark.createDataFrame([(1, 3), (1, 0), (None, 4), (2, None)], "n int, d int")
    got = [r.r for r in df.select(safe_ratio("n", "d", 4).alias("r")).collect()]
    assert got == [0.3333, None, None, None]


def test_safe_ratio_rounds_binary_value(spark):
    # 1.005 is stored as 1.00499999...; rounding the binary value gives 1.0
    df = spark.createDataFrame([(1.005, 1)], "n double, d int")
    assert df.select(safe_ratio("n", "d", 2).alias("r")).first().r == 1.0


def test_flag_null_is_false(spark):
    df = spark.createDataFrame([("converted",), ("new",), (None,)], "s string")
    got = [r.f for r in df.select(flag(F.col("s") == "converted").alias("f")).collect()]
    assert got == [True, False, False]


def test_days_between_counts_midnights(spark):
    df = spark.createDataFrame(
        [(datetime(2024, 1, 1, 23, 0), datetime(2024, 1, 2, 1, 0)), (datetime(2024, 1, 3, 1, 0), datetime(2024, 1, 1, 23, 0))],
        "a timestamp_ntz, b timestamp_ntz",
    )
    got = [r.d for r in df.select(days_between("a", "b").alias("d")).collect()]
    assert got == [1, -2]


def test_zero_fill_keeps_bigint(spark):
    df = spark.createDataFrame([(None,), (3,)], "c bigint")
    out = df.select(zero_fill("c").alias("z"))
    assert out.schema["z"].dataType.simpleString() == "bigint"
    assert [r.z for r in out.collect()] == [0, 3]


def test_sql_forms_equal_column_forms(spark):
    from lakeops.functions import days_between_sql, safe_ratio_sql, surrogate_key_sql, zero_fill_sql

    df = spark.createDataFrame(
        [(1, "g", 10, 3, None, datetime(2024, 1, 1, 23, 0), datetime(2024, 1, 2, 1, 0)),
         (None, None, 5, 0, 4, datetime(2024, 1, 3), datetime(2024, 1, 1))],
        "a long, b string, n int, d int, c bigint, s timestamp_ntz, e timestamp_ntz",
    )
    cols = df.select(
        surrogate_key("a", "b").alias("k"), safe_ratio(F.col("n"), F.col("d"), 2).alias("r"),
        zero_fill(F.col("c")).alias("z"), days_between(F.col("s"), F.col("e")).alias("dd"),
    ).collect()
    text = df.selectExpr(
        f"{surrogate_key_sql('a', 'b')} AS k", f"{safe_ratio_sql('n', 'd', 2)} AS r",
        f"{zero_fill_sql('c')} AS z", f"{days_between_sql('s', 'e')} AS dd",
    ).collect()
    assert cols == text


def test_light_keys_are_given_back_exactly(spark):
    rows = [(1, "a", md5("1-a")), (1, "a", md5("1-A")), (2, None, None), (3, "c", ""), (4, "d", "=x"), (None, None, md5(f"{NULL_PLACEHOLDER}-{NULL_PLACEHOLDER}"))]
    df = spark.createDataFrame(rows, "id int, ch string, k string").withColumn("whole", F.col("k"))
    light = df.withColumn("k", F.expr(light_key_sql("k", "id", "ch")))
    got = [(r.light, r.k, r.whole) for r in light.selectExpr("k AS light", f"{whole_key_sql('k', 'id', 'ch')} AS k", "whole").collect()]
    assert [(k, w) for _, k, w in got] == [(k, k) for _, _, k in rows]
    assert [x for x, _, _ in got] == ["", "=" + md5("1-A"), None, "=", "==x", ""]
