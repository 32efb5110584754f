"""Column helpers for derived measures: ratios, flags, day counts, zero fill.

Each helper has a SQL-text form (``*_sql``) for ``selectExpr`` projections and
a Column form. Given column names, the Column form is the same text parsed
once (``F.expr``); given Column objects, it composes them.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakeops.functions.keys import quote


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ts_sql(value: datetime | str) -> str:
    """A ``timestamp_ntz`` literal as SQL text."""
    text = value.isoformat(sep=" ") if isinstance(value, datetime) else str(value)
    return f"TIMESTAMP_NTZ '{text}'"


def _operand(x) -> str | None:
    """SQL text for a column name or a date/time value; None for a Column."""
    if isinstance(x, str):
        return quote(x)
    if isinstance(x, datetime):
        return ts_sql(x)
    if isinstance(x, date):
        return f"DATE '{x.isoformat()}'"
    return None


def round_half_away_sql(x: str, places: int) -> str:
    scale = f"CAST({10**places} AS DOUBLE)"
    return f"(round(({x}) * {scale}) / {scale})"


def round_half_away(x: Column, places: int) -> Column:
    """Round a double to ``places`` decimals by scaling the binary value.

    ``F.round(x, n)`` rounds the decimal text of ``x``; scaling first rounds the
    binary value, as the reference's engine does (28 of 200,000 cost values
    differ otherwise).
    """
    scale = float(10**places)
    return F.round(x * F.lit(scale)) / F.lit(scale)


def safe_ratio_sql(num: str, den: str, places: int | None = None) -> str:
    """``safe_ratio`` over two column names, as SQL text."""
    n, d = f"CAST({quote(num)} AS DOUBLE)", f"CAST({quote(den)} AS DOUBLE)"
    q = f"{n} / {d}"
    if places is not None:
        q = round_half_away_sql(q, places)
    return f"CASE WHEN {d} <> CAST(0 AS DOUBLE) THEN {q} END"


def safe_ratio(num: str | Column, den: str | Column, places: int | None = None) -> Column:
    """``num / den`` as double, NULL when the denominator is 0 or NULL.

    Both sides are cast to double first (a decimal divided by an integer is a
    double in the reference), and the guard keeps ANSI division from raising.
    """
    if isinstance(num, str) and isinstance(den, str):
        return F.expr(safe_ratio_sql(num, den, places))
    n = _col(num).cast("double")
    d = _col(den).cast("double")
    q = n / d
    if places is not None:
        q = round_half_away(q, places)
    return F.when(d.isNotNull() & (d != F.lit(0.0)), q)


def flag_sql(cond: str) -> str:
    return f"CASE WHEN {cond} THEN true ELSE false END"


def flag(cond: str | Column) -> Column:
    """``case when cond then true else false``: a NULL condition gives false.

    ``cond`` is a Column or SQL condition text.
    """
    if isinstance(cond, str):
        return F.expr(flag_sql(cond))
    return F.when(cond, F.lit(True)).otherwise(F.lit(False))


def zero_fill_sql(c: str) -> str:
    return f"coalesce({quote(c)}, CAST(0 AS BIGINT))"


def zero_fill(c: str | Column) -> Column:
    """Missing counts become 0, keeping the bigint type."""
    if isinstance(c, str):
        return F.expr(zero_fill_sql(c))
    return F.coalesce(c, F.lit(0).cast("bigint"))


def days_between_sql(start, end) -> str:
    """``days_between`` over column names or date/time values, as SQL text."""
    s, e = _operand(start), _operand(end)
    if s is None or e is None:
        raise TypeError("days_between_sql takes column names or date/time values")
    return f"CAST(datediff(CAST({e} AS DATE), CAST({s} AS DATE)) AS BIGINT)"


def days_between(start, end) -> Column:
    """Signed number of midnights crossed from ``start`` to ``end`` (bigint).

    23:00 to 01:00 the next day is 1. This is the calendar difference of the
    two dates, not a count of whole 24-hour spans. Each side is a column name,
    a Column, or a date/time value.
    """
    if _operand(start) is not None and _operand(end) is not None:
        return F.expr(days_between_sql(start, end))
    s = _col(start) if not isinstance(start, (date, datetime)) else F.expr(_operand(start))
    e = _col(end) if not isinstance(end, (date, datetime)) else F.expr(_operand(end))
    return F.datediff(e.cast("date"), s.cast("date")).cast("bigint")


def ts_literal(value: datetime | str) -> Column:
    """A ``timestamp_ntz`` literal; wall-clock time, independent of any zone."""
    text = value.isoformat(sep=" ") if isinstance(value, datetime) else str(value)
    return F.lit(text).cast("timestamp_ntz")


def date_literal(value: date | str) -> Column:
    text = value.isoformat() if isinstance(value, date) else str(value)
    return F.lit(text).cast("date")
