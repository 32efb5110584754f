"""Keep the latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeops.functions.keys import quote


def _desc(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).desc_nulls_last()


def latest_by(
    df: DataFrame,
    keys: Sequence[str],
    order_col: str | Column,
    tiebreak: Sequence[str | Column] = (),
) -> DataFrame:
    """One row per ``keys``: the one with the greatest ``order_col``.

    ``row_number() over (partition by keys order by order_col desc nulls last,
    *tiebreak desc nulls last) = 1``. Ties on the full order pick any of the
    tied rows, so pass a tie-break whenever equal order values can occur.

    Scale: the ``rn = 1`` filter lets Catalyst plan a partial
    ``WindowGroupLimit`` before the shuffle, so every map task forwards at most
    one row per key. A key re-sent millions of times (a hot key holding a third
    of the input) therefore costs one row per task in the exchange, not all of
    its rows in one reducer.
    """
    if not keys:
        raise ValueError("latest_by needs at least one key column")
    rn = "__lakeops_rn"
    order = [order_col, *tiebreak]
    if all(isinstance(c, str) for c in order):
        # Same window as SQL text: one parse instead of a Column object per part.
        part = ", ".join(quote(k) for k in keys)
        by = ", ".join(f"{quote(c)} DESC NULLS LAST" for c in order)
        ranked = df.selectExpr("*", f"row_number() OVER (PARTITION BY {part} ORDER BY {by}) AS {rn}")
    else:
        w = Window.partitionBy(*keys).orderBy(*[_desc(c) for c in order])
        ranked = df.withColumn(rn, F.row_number().over(w))
    return ranked.where(f"{rn} = 1").drop(rn)
