"""Counts by key, conditional counts, distinct keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.functions.keys import quote


def counts_by(
    df: DataFrame,
    keys: Sequence[str | Column],
    name: str = "n",
    where: Mapping[str, Column | str] | None = None,
) -> DataFrame:
    """``count(*)`` per key, plus ``count(*) filter (where cond)`` per entry of ``where``.

    A condition is a Column or SQL condition text; NULL counts as false. One
    partial + final hash aggregate: each map task sends one row per key, so a
    hot key does not concentrate rows in the shuffle.
    """
    aggs = [F.expr(f"count(1) AS {quote(name)}")]
    for out, cond in (where or {}).items():
        if isinstance(cond, str):
            aggs.append(F.expr(f"count_if(coalesce({cond}, false)) AS {quote(out)}"))
        else:
            aggs.append(F.count_if(F.coalesce(cond, F.lit(False))).alias(out))
    return df.groupBy(*keys).agg(*aggs)


def distinct_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Distinct values of the key columns."""
    return df.select(*keys).distinct()
