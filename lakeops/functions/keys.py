"""Surrogate keys: md5 over the text form of the natural key."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's key macro, so keys agree with it.
NULL_PLACEHOLDER = "_dbt_utils_surrogate_key_null_"
SEPARATOR = "-"


def surrogate_key(*cols: str | Column) -> Column:
    """md5 hex of the parts' text joined by ``-``; a NULL part becomes a placeholder.

    Never NULL itself, and identical to the hash the reference's models write
    for the same raw values (the text form of integers, strings and ISO dates
    is the same in both engines).
    """
    if not cols:
        raise ValueError("surrogate_key needs at least one column")
    parts = [
        F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(NULL_PLACEHOLDER))
        for c in cols
    ]
    return F.md5(F.concat_ws(SEPARATOR, *parts))


def quote(name: str) -> str:
    """A column name as a SQL identifier."""
    return "`" + name.replace("`", "``") + "`"


def surrogate_key_sql(*cols: str) -> str:
    """``surrogate_key`` as SQL expression text, for ``selectExpr`` projections."""
    if not cols:
        raise ValueError("surrogate_key needs at least one column")
    parts = ", ".join(f"coalesce(CAST({quote(c)} AS STRING), '{NULL_PLACEHOLDER}')" for c in cols)
    return f"md5(concat_ws('{SEPARATOR}', {parts}))"


def light_key_sql(key: str, *cols: str) -> str:
    """What a shuffle has to carry of a surrogate key where the columns ``cols`` go along: empty if ``key`` is the key of these.

    A hash does not compress, so it is the widest column of most rows. Any other key, as one that was made of differently
    spelt values, is carried whole, behind a mark; NULL stays NULL. ``whole_key_sql`` gives back exactly ``key``.
    """
    return f"CASE WHEN {quote(key)} = {surrogate_key_sql(*cols)} THEN '' ELSE concat('=', {quote(key)}) END"


def whole_key_sql(key: str, *cols: str) -> str:
    """The key that ``light_key_sql`` made light, from the same columns."""
    return f"CASE WHEN {quote(key)} = '' THEN {surrogate_key_sql(*cols)} ELSE substr({quote(key)}, 2) END"
