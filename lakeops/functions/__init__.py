"""Column-level building blocks (all built-in Spark expressions, no UDFs).

Each helper comes as a Column function and as SQL expression text (``*_sql``)
for ``selectExpr`` projections.
"""

from lakeops.functions.keys import NULL_PLACEHOLDER, quote, surrogate_key, surrogate_key_sql
from lakeops.functions.measures import (
    date_literal,
    days_between,
    days_between_sql,
    flag,
    flag_sql,
    round_half_away,
    round_half_away_sql,
    safe_ratio,
    safe_ratio_sql,
    ts_literal,
    ts_sql,
    zero_fill,
    zero_fill_sql,
)

__all__ = [
    "NULL_PLACEHOLDER",
    "quote",
    "surrogate_key",
    "surrogate_key_sql",
    "date_literal",
    "days_between",
    "days_between_sql",
    "flag",
    "flag_sql",
    "round_half_away",
    "round_half_away_sql",
    "safe_ratio",
    "safe_ratio_sql",
    "ts_literal",
    "ts_sql",
    "zero_fill",
    "zero_fill_sql",
]
