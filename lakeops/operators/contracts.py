"""Schema contracts: exact columns and types, NOT NULL enforced inside the write plan."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Contract type names (the reference's vocabulary) and the Spark type each means.
# ``timestamp`` is a zone-less wall-clock time there, i.e. Spark's TIMESTAMP_NTZ.
CONTRACT_TYPES: dict[str, T.DataType] = {
    "varchar": T.StringType(),
    "integer": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampNTZType(),
    "timestamp with time zone": T.TimestampType(),
}


class ContractViolation(Exception):
    """The DataFrame does not have the contracted columns and types."""

    def __init__(self, table: str, problems: list[tuple[str, str | None, str | None, str]]):
        self.table = table
        self.problems = problems
        lines = [f"  {col}: {issue} (expected {exp}, got {act})" for col, exp, act, issue in problems]
        super().__init__(f"contract of {table} violated:\n" + "\n".join(lines))


@dataclass(frozen=True)
class ColumnContract:
    name: str
    data_type: str
    not_null: bool = False


@dataclass(frozen=True)
class Contract:
    table: str
    columns: tuple[ColumnContract, ...]

    @staticmethod
    def of(table: str, cols: Iterable[tuple[str, str, bool]]) -> Contract:
        return Contract(table, tuple(ColumnContract(n, t, nn) for n, t, nn in cols))

    @property
    def not_null_columns(self) -> list[str]:
        return [c.name for c in self.columns if c.not_null]


def type_name(dt: T.DataType) -> str:
    """Spark type in contract vocabulary (``decimal(p,s)``, ``null`` for an untyped NULL)."""
    if isinstance(dt, T.DecimalType):
        return f"decimal({dt.precision},{dt.scale})"
    if isinstance(dt, T.NullType):
        return "null"
    for name, t in CONTRACT_TYPES.items():
        if dt == t:
            return name
    return dt.simpleString()


def _norm(name: str) -> str:
    return name.replace(" ", "").lower() if name.startswith("decimal") else name.lower()


def schema_diff(df: DataFrame, contract: Contract) -> list[tuple[str, str | None, str | None, str]]:
    """``(column, expected, actual, issue)`` per contracted or present column.

    ``issue`` is ``ok``, ``missing``, ``extra`` or ``type_mismatch``. Reads
    only the schema; no job runs.
    """
    actual = {f.name: type_name(f.dataType) for f in df.schema.fields}
    out = []
    for c in contract.columns:
        act = actual.get(c.name)
        if act is None:
            out.append((c.name, c.data_type, None, "missing"))
        elif _norm(act) != _norm(c.data_type):
            out.append((c.name, c.data_type, act, "type_mismatch"))
        else:
            out.append((c.name, c.data_type, act, "ok"))
    declared = {c.name for c in contract.columns}
    out.extend((n, None, t, "extra") for n, t in actual.items() if n not in declared)
    return out


def enforce(df: DataFrame, contract: Contract) -> DataFrame:
    """Fail before publishing when the schema breaks the contract; else return
    the columns in contract order with NOT NULL checked row by row.

    Parquet tables accept NULL into NOT NULL columns, so the check lives in the
    plan: ``coalesce(c, raise_error(...))`` fails the write job on the first
    NULL without an extra pass over the data.
    """
    problems = [p for p in schema_diff(df, contract) if p[3] != "ok"]
    if problems:
        raise ContractViolation(contract.table, problems)
    cols = []
    for c in contract.columns:
        col = F.col(c.name)
        if c.not_null:
            col = F.coalesce(col, F.raise_error(F.lit(f"NOT NULL constraint failed: {contract.table}.{c.name}")))
        cols.append(col.alias(c.name))
    return df.select(*cols)


def null_report(df: DataFrame, contract: Contract) -> DataFrame:
    """``table_name, column_name, null_rows`` of every NOT NULL column, in one aggregate: the rows ``enforce`` stops at."""
    held = [c.name for c in contract.columns if c.not_null]
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"__{i}") for i, c in enumerate(held)])
    rows = F.array(*[F.struct(F.lit(c).alias("c"), F.col(f"__{i}").alias("n")) for i, c in enumerate(held)])
    return counts.select(F.inline(rows)).select(
        F.lit(contract.table).alias("table_name"), F.col("c").alias("column_name"), F.col("n").alias("null_rows")
    )


def _sql_text(v: str | None) -> str:
    return "CAST(NULL AS STRING)" if v is None else "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


def contract_report(df: DataFrame, contract: Contract, table_name: str | None = None) -> DataFrame:
    """One row per contracted or present column: types, issue and NULL count.

    ``table_name, column_name, expected_type, actual_type, issue, not_null,
    null_rows``. NULL counts of all present columns come from one aggregate
    pass; the schema part is folded into the same projection.
    """
    name = table_name or contract.table
    diff = schema_diff(df, contract)
    declared_nn = {c.name: c.not_null for c in contract.columns}
    present = [f.name for f in df.schema.fields]
    idx = {c: i for i, c in enumerate(present)}
    counts = df.selectExpr(
        *[f"count_if(`{c.replace('`', '``')}` IS NULL) AS __null_{i}" for i, c in enumerate(present)]
    )
    rows = []
    for col, exp, act, issue in diff:
        nulls = f"__null_{idx[col]}" if col in idx else "CAST(NULL AS BIGINT)"
        rows.append(
            f"named_struct('table_name', {_sql_text(name)}, 'column_name', {_sql_text(col)}, "
            f"'expected_type', {_sql_text(exp)}, 'actual_type', {_sql_text(act)}, 'issue', {_sql_text(issue)}, "
            f"'not_null', {'true' if declared_nn.get(col, False) else 'false'}, 'null_rows', CAST({nulls} AS BIGINT))"
        )
    return counts.selectExpr(f"inline(array({', '.join(rows)}))")
