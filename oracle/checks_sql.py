"""DuckDB SQL for check and contract results, from the same declarations the
Spark queries use. Each check becomes one independent SELECT (the oracle does
not share the one-pass evaluation of the Spark side)."""

from __future__ import annotations

from datetime import datetime, timedelta

from lakeops.operators.checks import Check
from lakeops.operators.contracts import Contract


def _s(v) -> str:
    if v is None:
        return "CAST(NULL AS VARCHAR)"
    return "'" + str(v).replace("'", "''") + "'"


def _q(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def _v(v) -> str:
    return _s(v) if isinstance(v, str) else repr(v)


def _ts(t: datetime) -> str:
    return f"TIMESTAMP '{t.isoformat(sep=' ')}'"


def _us(d: timedelta) -> int:
    return (d.days * 86_400 + d.seconds) * 1_000_000 + d.microseconds


def _head(c: Check, table: str) -> str:
    return f"SELECT {_s(c.kind)} AS \"check\", {_s(table)} AS table_name, {_s(c.column)} AS column_name"


def check_sql(table: str, c: Check) -> str:
    h = _head(c, table)
    col = _q(c.column) if c.column else None
    null = "CAST(NULL AS BIGINT)"
    if c.kind == "not_null":
        return (
            f"{h}, count_if({col} IS NULL) = 0 AS success, count(*) AS observed, "
            f"count_if({col} IS NULL) AS unexpected, CAST(NULL AS VARCHAR) AS detail FROM {table}"
        )
    if c.kind == "accepted_values":
        vals = ", ".join(_v(v) for v in c.values)
        bad = f"count_if({col} IS NOT NULL AND {col} NOT IN ({vals}))"
        return f"{h}, {bad} = 0 AS success, count(*) AS observed, {bad} AS unexpected, CAST(NULL AS VARCHAR) AS detail FROM {table}"
    if c.kind == "between":
        conds = []
        if c.lo is not None:
            conds.append(f"{col} < {_v(c.lo)}")
        if c.hi is not None:
            conds.append(f"{col} > {_v(c.hi)}")
        outside = " OR ".join(conds) or "false"
        bad = f"count_if({col} IS NOT NULL AND ({outside}))"
        return f"{h}, {bad} = 0 AS success, count({col}) AS observed, {bad} AS unexpected, CAST(NULL AS VARCHAR) AS detail FROM {table}"
    if c.kind in ("row_count_between", "row_count_min"):
        conds = ["true"]
        if c.lo is not None:
            conds.append(f"count(*) >= {c.lo}")
        if c.hi is not None:
            conds.append(f"count(*) <= {c.hi}")
        return (
            f"{h}, ({' AND '.join(conds)}) AS success, count(*) AS observed, {null} AS unexpected, "
            f"CAST(NULL AS VARCHAR) AS detail FROM {table}"
        )
    if c.kind == "row_count_near":
        dev = f"abs(count(*) - {c.expected})"
        return (
            f"{h}, CAST({dev} AS DOUBLE) / {float(c.expected)} < {c.tol} AS success, count(*) AS observed, "
            f"{dev} AS unexpected, CAST(NULL AS VARCHAR) AS detail FROM {table}"
        )
    if c.kind == "has_columns":
        names = "[" + ", ".join(_s(n) for n in c.names) + "]"
        return (
            f"{h}, len(missing) = 0 AS success, {len(c.names)} - len(missing) AS observed, "
            f"len(missing) AS unexpected, "
            f"CASE WHEN len(missing) = 0 THEN NULL ELSE array_to_string(list_sort(missing), ',') END AS detail "
            f"FROM (SELECT list_filter({names}, lambda x: NOT list_contains(k, x)) AS missing "
            f"FROM (SELECT any_value(json_keys(to_json(t))) AS k FROM {table} t))"
        )
    if c.kind == "unique":
        return (
            f"{h}, dup = 0 AS success, obs AS observed, dup AS unexpected, CAST(NULL AS VARCHAR) AS detail FROM ("
            f"SELECT coalesce(sum(n), 0) AS obs, coalesce(sum(CASE WHEN n > 1 THEN n END), 0) AS dup FROM ("
            f"SELECT count(*) AS n FROM {table} WHERE {col} IS NOT NULL GROUP BY {col}))"
        )
    if c.kind == "relationship":
        pc = _q(c.parent_col)
        return (
            f"{h}, orph = 0 AS success, obs AS observed, orph AS unexpected, "
            f"{_s(f'{c.parent_name}.{c.parent_col}')} AS detail FROM ("
            f"SELECT count(*) AS obs, count_if(p.k IS NULL) AS orph "
            f"FROM (SELECT {col} AS k FROM {table} WHERE {col} IS NOT NULL) ch "
            f"LEFT JOIN (SELECT DISTINCT {pc} AS k FROM {c.parent_name} WHERE {pc} IS NOT NULL) p ON ch.k = p.k)"
        )
    if c.kind in ("freshness", "staleness"):
        inner = (
            f"SELECT max({col}) AS m, date_diff('microsecond', CAST(max({col}) AS TIMESTAMP), {_ts(c.now)}) AS age_us "
            f"FROM {table}"
        )
        age_s = "CAST(floor(age_us / 1000000) AS BIGINT)"
        if c.kind == "freshness":
            whens = ["WHEN m IS NULL THEN 'error'"]
            if c.error is not None:
                whens.append(f"WHEN age_us > {_us(c.error)} THEN 'error'")
            if c.warn is not None:
                whens.append(f"WHEN age_us > {_us(c.warn)} THEN 'warn'")
            status = f"CASE {' '.join(whens)} ELSE 'pass' END"
            return (
                f"{h}, {status} <> 'error' AS success, {age_s} AS observed, {null} AS unexpected, "
                f"{status} AS detail FROM ({inner})"
            )
        fresh = f"(m IS NOT NULL AND age_us <= {_us(c.error)})"
        return (
            f"{h}, {fresh} AS success, {age_s} AS observed, {null} AS unexpected, "
            f"CASE WHEN {fresh} THEN 'fresh' ELSE 'stale' END AS detail FROM ({inner})"
        )
    raise ValueError(f"no SQL for check {c.kind}")


def checks_sql(spec: dict[str, list[Check]]) -> str:
    parts = [
        f'SELECT "check", table_name, column_name, success, CAST(observed AS BIGINT) AS observed, '
        f"CAST(unexpected AS BIGINT) AS unexpected, detail FROM ({check_sql(t, c)})"
        for t, cs in spec.items()
        for c in cs
    ]
    return "\nUNION ALL\n".join(f"({p})" for p in parts)


def contract_sql(table: str, contract: Contract, present: set[str] | None = None) -> str:
    """Rows like ``contract_report``; ``present`` names the columns the table has
    (``None``: all contracted columns)."""
    parts = []
    for c in contract.columns:
        if present is not None and c.name not in present:
            parts.append(
                f"SELECT {_s(table)} AS table_name, {_s(c.name)} AS column_name, {_s(c.data_type)} AS expected_type, "
                f"CAST(NULL AS VARCHAR) AS actual_type, 'missing' AS issue, {str(c.not_null).lower()} AS not_null, "
                f"CAST(NULL AS BIGINT) AS null_rows"
            )
            continue
        actual = f"lower(replace(any_value(typeof({_q(c.name)})), '\"', ''))"
        parts.append(
            f"SELECT {_s(table)} AS table_name, {_s(c.name)} AS column_name, {_s(c.data_type)} AS expected_type, "
            f"{actual} AS actual_type, CASE WHEN {actual} = {_s(c.data_type)} THEN 'ok' ELSE 'type_mismatch' END AS issue, "
            f"{str(c.not_null).lower()} AS not_null, CAST(count_if({_q(c.name)} IS NULL) AS BIGINT) AS null_rows FROM {table}"
        )
    return "\nUNION ALL\n".join(f"({p})" for p in parts)
