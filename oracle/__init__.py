"""DuckDB oracle queries: for every Spark query key, the same result in SQL.

Each query is ``WITH <base.sql> <final select>``; DuckDB only evaluates the
CTEs a final select references. The views ``region nation customer supplier
part orders lineitem events`` are registered by the caller.
"""

from __future__ import annotations

from pathlib import Path

from oracle.checks_sql import checks_sql, contract_sql
from oracle.finals import FINALS

_BASE = (Path(__file__).parent / "base.sql").read_text()


def _finals() -> dict[str, str]:
    from lakeops.plans import quality
    from lakeops.plans.queries import BROKEN_DIM, CHECK_SPECS

    out = dict(FINALS)
    contract_parts = [contract_sql(t, c) for t, c in quality.MART_CONTRACTS.items()]
    dim = quality.MART_CONTRACTS["dim_clients"]
    broken_cols = {c.name for c in dim.columns} - {"client_name"}
    contract_parts.append(contract_sql(BROKEN_DIM, dim, broken_cols))
    out["contract_diff"] = "\nUNION ALL\n".join(contract_parts)
    for key, spec in CHECK_SPECS.items():
        out[key] = checks_sql(spec(lambda name: None))
    both = " UNION ALL ".join(f"SELECT * FROM ({out[f'suite_{t}']}) AS {t}_results" for t in ("clients", "leads"))
    out["gate_failures"] = f"SELECT * FROM ({both}) AS results WHERE NOT success"
    return out


def sql(key: str) -> str:
    return f"WITH {_BASE}\n{_finals()[key]}"


def all_sql() -> dict[str, str]:
    return {k: f"WITH {_BASE}\n{v}" for k, v in _finals().items()}
