"""Data-quality checks as distributed aggregates.

Every check yields one row ``check, table_name, column_name, success,
observed, unexpected, detail``. All checks of one table that are plain
counts share a single aggregate pass; ``unique`` and ``relationship`` need a
grouping each, pre-aggregated per key before any shuffle of raw rows. With
``two_pass``, ``unique`` is answered without shuffling its keys (see
`lakeops.operators.uniqueness`). Else nothing is pulled to the driver except
by ``gate``, which collects only failed rows (one per failed check).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from datetime import date, datetime, timedelta
from decimal import Decimal
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.operators.uniqueness import find_repeats

RESULT_SCHEMA = T.StructType(
    [
        T.StructField("check", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("column_name", T.StringType()),
        T.StructField("success", T.BooleanType()),
        T.StructField("observed", T.LongType()),
        T.StructField("unexpected", T.LongType()),
        T.StructField("detail", T.StringType()),
    ]
)
RESULT_COLUMNS = tuple(f.name for f in RESULT_SCHEMA.fields)


class QualityGateFailed(Exception):
    def __init__(self, failures: list[dict]):
        self.failures = failures
        lines = [
            f"  {f['table_name']}.{f['column_name'] or '*'}: {f['check']} "
            f"(observed={f['observed']}, unexpected={f['unexpected']}, detail={f['detail']})"
            for f in failures
        ]
        super().__init__(f"data quality gate failed ({len(failures)} failures)\n" + "\n".join(lines))


@dataclass(frozen=True)
class Check:
    """A declared check. Build with the functions below, not directly."""

    kind: str
    column: str | None = None
    values: tuple = ()
    lo: Any = None
    hi: Any = None
    expected: int | None = None
    tol: float | None = None
    names: tuple[str, ...] = ()
    parent: DataFrame | None = field(default=None, compare=False, hash=False)
    parent_col: str | None = None
    parent_name: str | None = None
    warn: timedelta | None = None
    error: timedelta | None = None
    now: datetime | None = None


def not_null(col: str) -> Check:
    return Check("not_null", col)


def unique(col: str) -> Check:
    """No non-NULL value occurs twice (NULLs are ignored)."""
    return Check("unique", col)


def accepted_values(col: str, values: Iterable) -> Check:
    """Every non-NULL value is in ``values`` (NULLs pass)."""
    return Check("accepted_values", col, values=tuple(values))


def between(col: str, lo=None, hi=None) -> Check:
    """``lo <= value <= hi`` for non-NULL values; a missing bound is open."""
    return Check("between", col, lo=lo, hi=hi)


def row_count_between(lo: int | None = None, hi: int | None = None) -> Check:
    """Inclusive bounds on the row count; ``hi=None`` is a minimum only."""
    return Check("row_count_between", lo=lo, hi=hi)


def row_count_min(lo: int) -> Check:
    return Check("row_count_min", lo=lo)


def row_count_near(expected: int, tol: float) -> Check:
    """``|count - expected| / expected < tol`` (strictly)."""
    if expected <= 0:
        raise ValueError("expected row count must be positive")
    return Check("row_count_near", expected=expected, tol=tol)


def has_columns(names: Iterable[str]) -> Check:
    """All ``names`` are columns of the table; ``detail`` lists the missing ones."""
    return Check("has_columns", names=tuple(names))


def relationship(col: str, parent: DataFrame, parent_col: str, parent_name: str) -> Check:
    """Every non-NULL ``col`` value exists in ``parent.parent_col``."""
    return Check("relationship", col, parent=parent, parent_col=parent_col, parent_name=parent_name)


def freshness(col: str, warn: timedelta | None, error: timedelta | None, now: datetime) -> Check:
    """Age of ``max(col)`` at ``now``: ``error`` past the error limit, ``warn`` past the warn limit."""
    return Check("freshness", col, warn=warn, error=error, now=now)


def staleness(col: str, limit: timedelta, now: datetime) -> Check:
    """One limit: ``fresh`` while ``max(col)`` is at most ``limit`` old, else ``stale``."""
    return Check("staleness", col, error=limit, now=now)


def _us(d: timedelta) -> int:
    return (d.days * 86_400 + d.seconds) * 1_000_000 + d.microseconds


# Result rows are written as SQL expression text: every pass below is built
# with a handful of ``selectExpr`` calls (one parse each) instead of many small
# Column objects, which keeps plan construction cheap for suites of many checks.


def _ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, int):
        return str(v)
    if isinstance(v, float):
        return f"CAST('{v!r}' AS DOUBLE)"
    if isinstance(v, Decimal):
        return f"{v}BD"
    if isinstance(v, datetime):
        return f"TIMESTAMP_NTZ '{v.isoformat(sep=' ')}'"
    if isinstance(v, date):
        return f"DATE '{v.isoformat()}'"
    text = str(v).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'"


def _row(check: Check, table: str, success: str, observed: str, unexpected: str, detail: str) -> str:
    return (
        f"named_struct('check', {_lit(check.kind)}, 'table_name', {_lit(table)}, "
        f"'column_name', CAST({_lit(check.column)} AS STRING), 'success', coalesce({success}, false), "
        f"'observed', CAST({observed} AS BIGINT), 'unexpected', CAST({unexpected} AS BIGINT), "
        f"'detail', CAST({detail} AS STRING))"
    )


def _rows(df: DataFrame, rows: list[str]) -> DataFrame:
    return df.selectExpr(f"inline(array({', '.join(rows)}))")


def _type(df: DataFrame, col: str) -> str:
    return df.schema[col].dataType.simpleString()


COUNT_KINDS = ("row_count_between", "row_count_min", "row_count_near")
AGE_KINDS = ("freshness", "staleness")


def _count_row(c: Check, table: str) -> str:
    """Result of a row-count check from the column ``__n``."""
    if c.kind == "row_count_near":
        dev = f"abs(__n - {c.expected})"
        ok = f"CAST({dev} AS DOUBLE) / {_lit(float(c.expected))} < {_lit(float(c.tol))}"
        return _row(c, table, ok, "__n", dev, "NULL")
    ok = ["true"]
    if c.lo is not None:
        ok.append(f"__n >= {c.lo}")
    if c.hi is not None:
        ok.append(f"__n <= {c.hi}")
    return _row(c, table, " AND ".join(ok), "__n", "NULL", "NULL")


def _age_row(c: Check, table: str, m: str) -> str:
    """Result of a freshness or staleness check from the column ``m`` that holds the latest value."""
    age = (
        f"(unix_micros(CAST({_lit(c.now)} AS TIMESTAMP)) - "
        f"unix_micros(CAST(CAST({m} AS TIMESTAMP_NTZ) AS TIMESTAMP)))"
    )
    age_s = f"floor({age} / 1000000)"
    if c.kind == "staleness":
        fresh = f"({m} IS NOT NULL AND {age} <= {_us(c.error)})"
        return _row(c, table, fresh, age_s, "NULL", f"CASE WHEN {fresh} THEN 'fresh' ELSE 'stale' END")
    whens = [f"WHEN {m} IS NULL THEN 'error'"]
    if c.error is not None:
        whens.append(f"WHEN {age} > {_us(c.error)} THEN 'error'")
    if c.warn is not None:
        whens.append(f"WHEN {age} > {_us(c.warn)} THEN 'warn'")
    status = f"CASE {' '.join(whens)} ELSE 'pass' END"
    return _row(c, table, f"{status} <> 'error'", age_s, "NULL", status)


def latest_columns(checks: Sequence[Check]) -> list[str]:
    """Columns whose latest value the checks ask for."""
    return list(dict.fromkeys(c.column for c in checks if c.kind in AGE_KINDS))


def run_on_stats(stats: DataFrame, table: str, checks: Sequence[Check]) -> DataFrame:
    """Row-count, freshness and staleness checks from one row of statistics: ``row_count`` and the `latest_columns`.

    Gives the rows that `run_checks` gives on the table itself; other kinds of checks need its rows.
    """
    rows, place = [], {c: f"__m{i}" for i, c in enumerate(latest_columns(checks))}
    for c in checks:
        if c.kind not in COUNT_KINDS + AGE_KINDS:
            raise ValueError(f"{c.kind} cannot be answered from a table's statistics")
        rows.append(_count_row(c, table) if c.kind in COUNT_KINDS else _age_row(c, table, place[c.column]))
    return _rows(stats.selectExpr("row_count AS __n", *(f"{_ident(c)} AS {m}" for c, m in place.items())), rows)


def _evaluate(df: DataFrame, table: str, checks: Sequence[Check], serve_keys: Sequence[str] = ()) -> "_Evaluated":
    """The single-scan evaluation behind ``run_checks`` (see there).

    ``serve_keys`` are columns whose distinct values other tables' relationship
    checks need; they become extra key groups of the same scan.
    """
    present = set(df.columns)
    keyed = [(i, c) for i, c in enumerate(checks) if c.kind in ("unique", "relationship")]
    slot = {i: g for g, (i, _) in enumerate(keyed, start=1)}
    key_cols = {g: (_ident(c.column), _type(df, c.column)) for g, (_, c) in enumerate(keyed, start=1)}
    # A served column that already has a key group (unique/relationship on it) reuses that group.
    by_column = {c.column: slot[i] for i, c in keyed}
    served: dict[str, int] = {}
    for col in dict.fromkeys(serve_keys):
        if col in by_column:
            served[col] = by_column[col]
        else:
            served[col] = len(key_cols) + 1
            key_cols[served[col]] = (_ident(col), _type(df, col))

    flags: dict[str, tuple[str, str]] = {}  # name -> (row expression, type)
    finals = ["coalesce(sum(CASE WHEN __w = 0 THEN __c END), 0) AS __n"]
    rows: list[str] = []
    schema_rows: list[str] = []  # answered by the schema alone
    for i, c in enumerate(checks):
        col = _ident(c.column) if c.column else None
        s, m, obs, dup = f"__s{i}", f"__m{i}", f"__o{i}", f"__d{i}"
        if c.kind in ("not_null", "accepted_values", "between"):
            if c.kind == "not_null":
                bad = f"{col} IS NULL"
            elif c.kind == "accepted_values":
                bad = f"{col} IS NOT NULL AND NOT ({col} IN ({', '.join(_lit(v) for v in c.values)}))"
            else:
                outside = []
                if c.lo is not None:
                    outside.append(f"{col} < {_lit(c.lo)}")
                if c.hi is not None:
                    outside.append(f"{col} > {_lit(c.hi)}")
                bad = f"{col} IS NOT NULL AND ({' OR '.join(outside) or 'false'})"
                flags[obs] = (f"CASE WHEN {col} IS NOT NULL THEN 1 ELSE 0 END", "int")
                finals.append(f"coalesce(sum(CASE WHEN __w = 0 THEN {obs} END), 0) AS {obs}")
            flags[s] = (f"CASE WHEN {bad} THEN 1 ELSE 0 END", "int")
            finals.append(f"coalesce(sum(CASE WHEN __w = 0 THEN {s} END), 0) AS {s}")
            rows.append(_row(c, table, f"{s} = 0", obs if c.kind == "between" else "__n", s, "NULL"))
        elif c.kind in COUNT_KINDS:
            rows.append(_count_row(c, table))
        elif c.kind == "has_columns":
            missing = sorted(set(c.names) - present)
            detail = _lit(",".join(missing)) if missing else "NULL"
            schema_rows.append(_row(c, table, _lit(not missing), str(len(c.names) - len(missing)), str(len(missing)), detail))
        elif c.kind in AGE_KINDS:
            flags[m] = (col, _type(df, c.column))
            finals.append(f"max(CASE WHEN __w = 0 THEN {m} END) AS {m}")
            rows.append(_age_row(c, table, m))
        elif c.kind == "unique":
            g = slot[i]
            hit = f"__w = {g} AND __k{g} IS NOT NULL"
            finals.append(f"coalesce(sum(CASE WHEN {hit} THEN __c END), 0) AS {obs}")
            finals.append(f"coalesce(sum(CASE WHEN {hit} AND __c > 1 THEN __c END), 0) AS {dup}")
            rows.append(_row(c, table, f"{dup} = 0", obs, dup, "NULL"))

    # One expanded row per group: group 0 holds the flags, group g the g-th key.
    def element(g: int) -> str:
        parts = [f"'__w', {g}"]
        for h, (expr, typ) in key_cols.items():
            parts.append(f"'__k{h}', CAST({expr if h == g else 'NULL'} AS {typ})")
        for name, (expr, typ) in flags.items():
            parts.append(f"'{name}', CAST({expr if g == 0 else 'NULL'} AS {typ})")
        return f"named_struct({', '.join(parts)})"

    expanded = df.selectExpr(f"inline(array({', '.join(element(g) for g in range(len(key_cols) + 1))}))")
    group_cols = ["__w", *[f"__k{h}" for h in key_cols]]
    aggs = ["count(1) AS __c", *[f"sum({n}) AS {n}" if t == "int" else f"max({n}) AS {n}" for n, (_, t) in flags.items()]]
    grouped = expanded.groupBy(*group_cols).agg(*[F.expr(a) for a in aggs])

    def keys_of(g: int) -> DataFrame:
        return grouped.where(f"__w = {g} AND __k{g} IS NOT NULL").selectExpr(f"__k{g} AS __k", "__c")

    return _Evaluated(
        table=table,
        counted=[
            *([_rows(grouped.selectExpr(*finals), rows)] if rows else []),
            *([_rows(df.sparkSession.range(1), schema_rows)] if schema_rows else []),
        ],
        children=[(c, keys_of(slot[i])) for i, c in keyed if c.kind == "relationship"],
        served={col: keys_of(g).select("__k") for col, g in served.items()},
    )


@dataclass
class _Evaluated:
    table: str
    counted: list[DataFrame]  # results of the scan, results of the schema
    children: list  # (relationship check, child keys with row counts)
    served: dict  # column -> distinct non-NULL values, for checks that use this table as parent


def _unique_rows(df: DataFrame, table: str, checks: Sequence[Check]) -> list[DataFrame]:
    """Results of ``unique`` checks in two passes, of which the first runs now, for all of them together."""
    parts = []
    for c, found in zip(checks, find_repeats(df, [[c.column] for c in checks]), strict=True):
        totals = found.keys().selectExpr("coalesce(sum(rows), 0) AS __dup")
        parts.append(_rows(totals, [_row(c, table, "__dup = 0", str(found.rows), "__dup", "NULL")]))
    return parts


def _apart(checks: Sequence[Check], serve_keys: Sequence[str] = ()) -> tuple[list[Check], list[Check]]:
    """Checks for the one scan, and ``unique`` checks for two passes: those whose keys nothing else groups."""
    grouped = {c.column for c in checks if c.kind == "relationship"} | set(serve_keys)
    two = [c for c in checks if c.kind == "unique" and c.column not in grouped]
    return [c for c in checks if c not in two], two


def run_checks(df: DataFrame, table: str, checks: Sequence[Check], two_pass: bool = False) -> DataFrame:
    """Evaluate ``checks`` on ``df`` in one scan; one result row per check.

    Each input row is expanded into one row per key group: group 0 carries the
    per-row flags of the count checks (NULL, outside a set or a range, the
    loaded-at value), group ``i`` the key of the i-th ``unique`` or
    ``relationship`` check. One aggregate over ``(group, key)`` then gives row
    counts per key (partial aggregation first: group 0, a single key, becomes
    one row per task) and a global aggregate folds everything into the result
    row. Relationship checks join the per-key counts of their group with the
    parent's distinct keys.

    With ``two_pass`` the ``unique`` checks whose keys no other check groups
    are taken out of that scan: right for large tables whose keys hardly ever
    repeat, where the shuffle of all keys costs more than another scan of them.
    """
    if not checks:
        return df.sparkSession.createDataFrame([], RESULT_SCHEMA)
    return run_many({table: df}, {table: checks}, two_pass)


def _relationship_rows(child: DataFrame, table: str, c: Check, parent_keys: DataFrame | None = None) -> DataFrame:
    # Child keys arrive counted per key, so a hot key is one row in the join.
    if parent_keys is None:
        parent_keys = c.parent.selectExpr(f"{_ident(c.parent_col)} AS __k").where("__k IS NOT NULL").distinct()
    parent = parent_keys.selectExpr("__k", "true AS __hit")
    totals = child.join(parent, "__k", "left").selectExpr(
        "coalesce(sum(__c), 0) AS __obs", "coalesce(sum(CASE WHEN __hit IS NULL THEN __c END), 0) AS __orph"
    )
    detail = _lit(f"{c.parent_name}.{c.parent_col}")
    return _rows(totals, [_row(c, table, "__orph = 0", "__obs", "__orph", detail)])


def run_many(tables: dict[str, DataFrame], checks: dict[str, Sequence[Check]], two_pass: bool = False) -> DataFrame:
    """``run_checks`` for several tables, as one result DataFrame.

    When a relationship's parent is itself a checked table of this run, the
    parent's keys come from that table's own scan instead of a second
    computation of the parent.
    """
    checked = [t for t, cs in checks.items() if cs]
    serve: dict[str, list[str]] = {}
    for t in checked:
        for c in checks[t]:
            if c.kind == "relationship":
                owner = next((p for p in checked if tables[p] is c.parent), None)
                if owner is not None:
                    serve.setdefault(owner, []).append(c.parent_col)
    done, parts = {}, []
    for t in checked:
        once, twice = _apart(checks[t], serve.get(t, ())) if two_pass else (checks[t], [])
        done[t] = _evaluate(tables[t], t, once, serve.get(t, ()))
        if twice:
            parts += _unique_rows(tables[t], t, twice)
    for t in checked:
        ev = done[t]
        parts += ev.counted
        for c, child in ev.children:
            owner = next((p for p in checked if tables[p] is c.parent), None)
            keys = done[owner].served.get(c.parent_col) if owner is not None else None
            parts.append(_relationship_rows(child, t, c, keys))
    return reduce(DataFrame.unionByName, parts)


def gate(results: DataFrame) -> DataFrame:
    """Raise ``QualityGateFailed`` listing every failed check; return ``results`` otherwise.

    Collects only the failed rows: at most one per declared check.
    """
    failed = [r.asDict() for r in results.where(~F.col("success")).collect()]
    if failed:
        raise QualityGateFailed(failed)
    return results
