"""Left joins that keep the fact grain, existence flags, and heavy keys joined apart."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.functions.keys import quote


FEWEST_ROWS = 1e-4  # the least share of rows that makes a key heavy: at most 10,000 keys are


def heavy_keys(df: DataFrame, keys: Sequence[str], share: float = 1e-3) -> dict[str, list]:
    """For each column, the values that hold about ``share`` of the rows or more: at most ``1 / share`` of them.

    One pass with a frequent-items sketch of bounded size per task (``approx_top_k``), so a value near the limit may be in or out.
    Joins give the same rows whatever is in the lists: they only say how the rows travel. NULL is never
    listed. An empty table has no heavy keys.
    """
    if not FEWEST_ROWS <= share <= 1:
        raise ValueError(f"share must lie between {FEWEST_ROWS} and 1")
    k = int(1 / share) + 1  # one more for NULL
    found = df.selectExpr(
        "count(1) AS n", *(f"approx_top_k({quote(c)}, {k}, {8 * k}) AS top{i}" for i, c in enumerate(keys))
    ).first()
    return {
        c: [t["item"] for t in found[f"top{i}"] if t["item"] is not None and t["count"] >= share * found["n"]]
        for i, c in enumerate(keys)
    }


def left_join_apart(left: DataFrame, right: DataFrame, key: str, heavy: Sequence) -> DataFrame:
    """Left join on one key, of which ``right`` has each value once; the rows of heavy keys do not go through the shuffle.

    The ``right`` rows of the heavy keys, at most one each, are broadcast to the rows of ``left`` on these keys. Rows of
    ``left`` without a key, which a shuffle would put into one task, stay where they are as well. All others are joined as usual.
    ``left`` is read once for each of the two parts. The result does not depend on what ``heavy`` lists.
    """
    column = F.col(quote(key))
    hot = column.isin(list(heavy))
    stay = left.where(column.isNull() | hot).join(F.broadcast(right.where(hot)), key, "left")
    go = left.where(column.isNotNull() & ~hot).join(right.where(~hot), key, "left")
    return stay.unionByName(go)


def enrich(
    fact: DataFrame, dim: DataFrame, keys: str | Sequence[str], cols: Sequence[str], heavy: Sequence = ()
) -> DataFrame:
    """Left-join dimension attributes onto a fact; orphan facts keep NULLs.

    The dimension must be unique on ``keys`` (the caller dedups it), so the fact
    grain is kept. No broadcast hint is given: Catalyst broadcasts the dimension
    only when its estimated size is under ``autoBroadcastJoinThreshold``, and
    AQE re-checks the measured size after the dimension's shuffle stage,
    falling back to a sort-merge join (with skew splitting of the fact side)
    beyond it. A dimension that grows with the data is therefore never
    broadcast blindly.

    ``heavy`` lists values of a single key (from `heavy_keys`) whose rows are
    joined apart, without a shuffle (see `left_join_apart`).
    """
    key_list = [keys] if isinstance(keys, str) else list(keys)
    if heavy:
        (key,) = key_list
        return left_join_apart(fact, dim.select(key, *cols), key, heavy)
    return fact.join(dim.select(*key_list, *cols), on=key_list, how="left")


def exists_flag(
    df: DataFrame, other: DataFrame, key: str, name: str, other_key: str | None = None, heavy: Sequence = ()
) -> DataFrame:
    """Add boolean ``name``: does ``key`` occur in ``other``?

    Left join to the *distinct* keys of ``other`` and test for a match, so the
    row count of ``df`` never grows. The distinct is a partial + final hash
    aggregate, so a key repeated a million times is reduced map-side. Rows of the ``heavy`` values of ``key``
    are joined apart (see `left_join_apart`).
    """
    ok = other_key or key
    marker = "__lakeops_hit"
    hits = (
        other.selectExpr(f"{quote(ok)} AS {quote(key)}")
        .where(f"{quote(key)} IS NOT NULL")
        .distinct()
        .selectExpr(quote(key), f"true AS {marker}")
    )
    joined = left_join_apart(df, hits, key, heavy) if heavy else df.join(hits, on=key, how="left")
    return joined.withColumn(name, F.expr(f"{marker} IS NOT NULL")).drop(marker)


def orphans(child: DataFrame, col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """Child keys (non-NULL) with no parent row, with how many child rows carry each.

    The child side is pre-aggregated per key before the anti join, so a hot
    child key is one row in the shuffle.
    """
    child_keys = child.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("__k")).agg(F.count("*").alias("rows"))
    parent_keys = parent.select(F.col(parent_col).alias("__k")).where(F.col("__k").isNotNull()).distinct()
    return child_keys.join(parent_keys, on="__k", how="left_anti").withColumnRenamed("__k", col)
