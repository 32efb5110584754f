"""Property tests: rounding and keys against independent models on random input."""

import hashlib
import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lakeops.functions import NULL_PLACEHOLDER, safe_ratio, surrogate_key


def engine_round(x: float, places: int) -> float:
    """Round the scaled binary value half away from zero, as the reference's engine does."""
    scale = 10.0**places
    q = x * scale
    r = math.floor(abs(q) + 0.5)
    return math.copysign(r, q) / scale


cents = st.integers(min_value=0, max_value=99_999_999)
counts = st.integers(min_value=0, max_value=10_000_000)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(cents, counts), min_size=1, max_size=200))
def test_cost_ratio_matches_engine_rounding(spark, pairs):
    df = spark.createDataFrame([(c / 100.0, n) for c, n in pairs], "spend double, clicks long")
    got = [r.q for r in df.select(safe_ratio("spend", "clicks", 2).alias("q")).collect()]
    want = [None if n == 0 else engine_round((c / 100.0) / n, 2) for c, n in pairs]
    assert got == want


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(-(2**62), 2**62)), st.one_of(st.none(), st.text(max_size=12))), min_size=1, max_size=50))
def test_surrogate_key_matches_md5_of_joined_text(spark, rows):
    df = spark.createDataFrame(rows, "a long, b string")
    got = [r.k for r in df.select(surrogate_key("a", "b").alias("k")).collect()]
    want = [
        hashlib.md5(
            "-".join(NULL_PLACEHOLDER if v is None else str(v) for v in (a, b)).encode("utf-8")
        ).hexdigest()
        for a, b in rows
    ]
    assert got == want


def test_configure_keeps_explicit_settings(spark):
    from lakeops.session import configure

    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    try:
        configure(spark)
        assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "false"
        assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    finally:
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")


def test_shuffle_partitions_sized_from_input():
    from lakeops.session import shuffle_partitions_for

    assert shuffle_partitions_for(100 * 1024**4) == 409_600
    assert shuffle_partitions_for(1) == 1
