"""Typing, case normalisation and audit stamps."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.functions.measures import ts_literal


def typed(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast the named columns in place (ANSI casts: bad text and overflow raise)."""
    return df.withColumns({c: F.col(c).cast(t) for c, t in types.items()})


def lowered(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Lower-case the named text columns in place."""
    return df.withColumns({c: F.lower(F.col(c)) for c in cols})


def stamp(df: DataFrame, col: str, run_ts: datetime | str) -> DataFrame:
    """Add one load time for the whole load (``_loaded_at`` / ``_dlt_load_time``)."""
    return df.withColumn(col, ts_literal(run_ts))
