"""Declared quality rules: contracts, test sets, expectation suites, freshness limits.

Everything here is data. The rules run through ``lakeops.operators.checks`` and
``lakeops.operators.contracts``.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame

from lakeops.operators import checks as C
from lakeops.operators.contracts import Contract
from lakeops.sources.bronze import Lake

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's declarations.
# ---------------------------------------------------------------------------

INDUSTRIES = ("legal", "dental", "home_services", "med_spa", "auto")
PLAN_TIERS = ("starter", "pro", "enterprise")
LEAD_SOURCES = ("organic", "paid", "referral", "social")
LEAD_STATUSES = ("new", "contacted", "qualified", "converted", "lost")
CHANNELS = ("google", "meta", "email")
APPOINTMENT_STATUSES = ("scheduled", "completed", "cancelled")

# Gold contracts: column, type, NOT NULL.
MART_CONTRACTS: dict[str, Contract] = {
    "dim_clients": Contract.of(
        "dim_clients",
        [
            ("client_key", "varchar", True),
            ("client_id", "integer", True),
            ("client_name", "varchar", True),
            ("industry", "varchar", True),
            ("plan_tier", "varchar", True),
            ("onboard_date", "date", True),
            ("city", "varchar", False),
            ("state", "varchar", False),
            ("days_active", "bigint", False),
            ("total_leads", "bigint", False),
            ("converted_leads", "bigint", False),
            ("total_appointments", "bigint", False),
            ("lead_conversion_rate", "double", False),
            ("_loaded_at", "timestamp", False),
        ],
    ),
    "fct_leads": Contract.of(
        "fct_leads",
        [
            ("lead_key", "varchar", True),
            ("lead_id", "integer", True),
            ("client_id", "integer", True),
            ("industry", "varchar", False),
            ("plan_tier", "varchar", False),
            ("lead_source", "varchar", False),
            ("lead_status", "varchar", False),
            ("lead_value", "decimal(10,2)", False),
            ("created_at", "timestamp", True),
            ("is_converted", "boolean", True),
            ("has_appointment", "boolean", False),
            ("age_days", "bigint", False),
            ("_loaded_at", "timestamp", False),
        ],
    ),
    "fct_ad_performance": Contract.of(
        "fct_ad_performance",
        [
            ("ad_spend_key", "varchar", True),
            ("client_id", "integer", True),
            ("industry", "varchar", False),
            ("plan_tier", "varchar", False),
            ("channel", "varchar", False),
            ("spend_date", "date", True),
            ("spend", "decimal(10,2)", True),
            ("impressions", "integer", False),
            ("clicks", "integer", False),
            ("ctr", "double", False),
            ("cpc", "double", False),
            ("daily_leads", "bigint", False),
            ("cpl", "double", False),
            ("_loaded_at", "timestamp", False),
        ],
    ),
    "fct_appointments": Contract.of(
        "fct_appointments",
        [
            ("appointment_key", "varchar", True),
            ("appointment_id", "integer", True),
            ("client_id", "integer", True),
            ("industry", "varchar", False),
            ("plan_tier", "varchar", False),
            ("lead_id", "integer", True),
            ("lead_source", "varchar", False),
            ("lead_value", "decimal(10,2)", False),
            ("appointment_status", "varchar", False),
            ("scheduled_at", "timestamp", True),
            ("lead_created_at", "timestamp", False),
            ("days_to_appointment", "bigint", False),
            ("is_completed", "boolean", False),
            ("_loaded_at", "timestamp", False),
        ],
    ),
}

# Declared tests on raw tables: (table, column, test, values).
SOURCE_TESTS: tuple[tuple[str, str, str, tuple], ...] = (
    ("raw_clients", "id", "not_null", ()),
    ("raw_clients", "id", "unique", ()),
    ("raw_clients", "name", "not_null", ()),
    ("raw_clients", "industry", "not_null", ()),
    ("raw_clients", "industry", "accepted_values", INDUSTRIES),
    ("raw_clients", "plan_tier", "not_null", ()),
    ("raw_clients", "plan_tier", "accepted_values", PLAN_TIERS),
    ("raw_clients", "onboard_date", "not_null", ()),
    ("raw_leads", "id", "not_null", ()),
    ("raw_leads", "id", "unique", ()),
    ("raw_leads", "client_id", "not_null", ()),
    ("raw_leads", "source", "accepted_values", LEAD_SOURCES),
    ("raw_leads", "status", "accepted_values", LEAD_STATUSES),
    ("raw_leads", "created_at", "not_null", ()),
    ("raw_appointments", "id", "not_null", ()),
    ("raw_appointments", "id", "unique", ()),
    ("raw_appointments", "lead_id", "not_null", ()),
    ("raw_appointments", "client_id", "not_null", ()),
    ("raw_appointments", "scheduled_at", "not_null", ()),
    ("raw_seo_rankings", "client_id", "not_null", ()),
    ("raw_seo_rankings", "keyword", "not_null", ()),
    ("raw_seo_rankings", "position", "not_null", ()),
    ("raw_seo_rankings", "snapshot_date", "not_null", ()),
    ("raw_ad_spend", "client_id", "not_null", ()),
    ("raw_ad_spend", "channel", "accepted_values", CHANNELS),
    ("raw_ad_spend", "date", "not_null", ()),
    ("raw_ad_spend", "spend", "not_null", ()),
)

# Declared tests on marts: (table, column, test, values); relationships name
# their parent as ("relationship", ("dim_clients", "client_id")).
MART_TESTS: tuple[tuple[str, str, str, tuple], ...] = (
    ("dim_clients", "client_key", "not_null", ()),
    ("dim_clients", "client_key", "unique", ()),
    ("dim_clients", "client_id", "not_null", ()),
    ("dim_clients", "client_id", "unique", ()),
    ("dim_clients", "client_name", "not_null", ()),
    ("dim_clients", "industry", "not_null", ()),
    ("dim_clients", "industry", "accepted_values", INDUSTRIES),
    ("dim_clients", "plan_tier", "not_null", ()),
    ("dim_clients", "plan_tier", "accepted_values", PLAN_TIERS),
    ("dim_clients", "onboard_date", "not_null", ()),
    ("fct_leads", "lead_key", "not_null", ()),
    ("fct_leads", "lead_key", "unique", ()),
    ("fct_leads", "lead_id", "not_null", ()),
    ("fct_leads", "lead_id", "unique", ()),
    ("fct_leads", "client_id", "not_null", ()),
    ("fct_leads", "client_id", "relationship", ("dim_clients", "client_id")),
    ("fct_leads", "lead_source", "accepted_values", LEAD_SOURCES),
    ("fct_leads", "lead_status", "accepted_values", LEAD_STATUSES),
    ("fct_leads", "created_at", "not_null", ()),
    ("fct_leads", "is_converted", "not_null", ()),
    ("fct_ad_performance", "ad_spend_key", "not_null", ()),
    ("fct_ad_performance", "ad_spend_key", "unique", ()),
    ("fct_ad_performance", "client_id", "not_null", ()),
    ("fct_ad_performance", "channel", "accepted_values", CHANNELS),
    ("fct_ad_performance", "spend_date", "not_null", ()),
    ("fct_ad_performance", "spend", "not_null", ()),
    ("fct_appointments", "appointment_key", "not_null", ()),
    ("fct_appointments", "appointment_key", "unique", ()),
    ("fct_appointments", "appointment_id", "not_null", ()),
    ("fct_appointments", "appointment_id", "unique", ()),
    ("fct_appointments", "client_id", "not_null", ()),
    ("fct_appointments", "lead_id", "not_null", ()),
    ("fct_appointments", "appointment_status", "accepted_values", APPOINTMENT_STATUSES),
    ("fct_appointments", "scheduled_at", "not_null", ()),
)

# Expectation suites, in expectation-suite JSON form.
SUITE_CLIENTS = {
    "expectation_suite_name": "stg_clients_suite",
    "expectations": [
        {"expectation_type": "expect_table_row_count_to_be_between", "kwargs": {"min_value": 490, "max_value": 510}},
        {"expectation_type": "expect_column_values_to_not_be_null", "kwargs": {"column": "client_id"}},
        {"expectation_type": "expect_column_values_to_be_unique", "kwargs": {"column": "client_id"}},
        {
            "expectation_type": "expect_column_values_to_be_in_set",
            "kwargs": {"column": "industry", "value_set": ["legal", "dental", "home_services", "med_spa", "auto"]},
        },
        {
            "expectation_type": "expect_column_values_to_be_in_set",
            "kwargs": {"column": "plan_tier", "value_set": ["starter", "pro", "enterprise"]},
        },
        {"expectation_type": "expect_column_values_to_not_be_null", "kwargs": {"column": "onboard_date"}},
    ],
}
SUITE_LEADS = {
    "expectation_suite_name": "stg_leads_suite",
    "expectations": [
        {"expectation_type": "expect_table_row_count_to_be_between", "kwargs": {"min_value": 17500, "max_value": 32500}},
        {"expectation_type": "expect_column_values_to_not_be_null", "kwargs": {"column": "lead_id"}},
        {"expectation_type": "expect_column_values_to_be_unique", "kwargs": {"column": "lead_id"}},
        {"expectation_type": "expect_column_values_to_not_be_null", "kwargs": {"column": "client_id"}},
        {
            "expectation_type": "expect_column_values_to_be_in_set",
            "kwargs": {"column": "lead_source", "value_set": ["organic", "paid", "referral", "social"]},
        },
        {
            "expectation_type": "expect_column_values_to_be_in_set",
            "kwargs": {"column": "lead_status", "value_set": ["new", "contacted", "qualified", "converted", "lost"]},
        },
        {
            "expectation_type": "expect_column_values_to_be_between",
            "kwargs": {"column": "lead_value", "min_value": 0, "max_value": 10000},
        },
    ],
}

# Source freshness (loaded-at column, warn after, error after).
SOURCE_FRESHNESS: dict[str, tuple[str, timedelta, timedelta]] = {
    "raw_clients": ("_loaded_at", timedelta(hours=25), timedelta(hours=48)),
    "raw_leads": ("_loaded_at", timedelta(hours=25), timedelta(hours=48)),
    "raw_appointments": ("_loaded_at", timedelta(hours=25), timedelta(hours=48)),
    "raw_seo_rankings": ("_dlt_load_time", timedelta(days=8), timedelta(days=14)),
    "raw_ad_spend": ("_dlt_load_time", timedelta(hours=25), timedelta(hours=48)),
}

# Staleness limits of published tables.
STALENESS_LIMITS: dict[str, timedelta] = {
    "silver": timedelta(hours=25),
    "gold": timedelta(hours=26),
    "stg_seo_rankings": timedelta(days=14),
}

# Row-count checks of published marts and the columns dim_clients must have.
DIM_CLIENTS_ROWS = (490, 510)
FCT_LEADS_MIN_ROWS = 17_500
FCT_AD_PERFORMANCE_EXPECTED_ROWS = 500 * 3 * 365
FCT_AD_PERFORMANCE_TOLERANCE = 0.05
DIM_CLIENTS_REQUIRED = (
    "client_key",
    "client_id",
    "client_name",
    "industry",
    "plan_tier",
    "onboard_date",
    "days_active",
    "total_leads",
    "lead_conversion_rate",
)

# ---------------------------------------------------------------------------
# Translating declarations into checks.
# ---------------------------------------------------------------------------

_EXPECTATIONS = {
    "expect_table_row_count_to_be_between": lambda kw: C.row_count_between(kw.get("min_value"), kw.get("max_value")),
    "expect_column_values_to_not_be_null": lambda kw: C.not_null(kw["column"]),
    "expect_column_values_to_be_unique": lambda kw: C.unique(kw["column"]),
    "expect_column_values_to_be_in_set": lambda kw: C.accepted_values(kw["column"], kw["value_set"]),
    "expect_column_values_to_be_between": lambda kw: C.between(kw["column"], kw.get("min_value"), kw.get("max_value")),
}


def suite_checks(suite: Mapping) -> list[C.Check]:
    """Checks of an expectation suite given in its JSON form."""
    out = []
    for exp in suite["expectations"]:
        kind = exp["expectation_type"]
        if kind not in _EXPECTATIONS:
            raise ValueError(f"unsupported expectation {kind}")
        out.append(_EXPECTATIONS[kind](exp.get("kwargs", {})))
    return out


def run_suite(df: DataFrame, table: str, suite: Mapping) -> DataFrame:
    """One result row per expectation; plain counts share one pass."""
    return C.run_checks(df, table, suite_checks(suite))


def declared_checks(
    tests: Sequence[tuple[str, str, str, tuple]], tables: Mapping[str, DataFrame]
) -> dict[str, list[C.Check]]:
    out: dict[str, list[C.Check]] = {}
    for table, column, test, arg in tests:
        if test == "not_null":
            chk = C.not_null(column)
        elif test == "unique":
            chk = C.unique(column)
        elif test == "accepted_values":
            chk = C.accepted_values(column, arg)
        elif test == "relationship":
            parent, parent_col = arg
            chk = C.relationship(column, tables[parent], parent_col, parent)
        else:
            raise ValueError(f"unknown test {test}")
        out.setdefault(table, []).append(chk)
    return out


def run_declared(tests: Sequence[tuple[str, str, str, tuple]], tables: Mapping[str, DataFrame]) -> DataFrame:
    return C.run_many(dict(tables), declared_checks(tests, tables))


def freshness_checks(tables: Iterable[str], now: datetime) -> dict[str, list[C.Check]]:
    return {t: [C.freshness(col, warn, err, now)] for t, (col, warn, err) in SOURCE_FRESHNESS.items() if t in tables}


def asset_checks() -> dict[str, list[C.Check]]:
    """The row-count and schema checks on published marts."""
    return {
        "dim_clients": [C.row_count_between(*DIM_CLIENTS_ROWS), C.has_columns(DIM_CLIENTS_REQUIRED)],
        "fct_leads": [C.row_count_min(FCT_LEADS_MIN_ROWS)],
        "fct_ad_performance": [C.row_count_near(FCT_AD_PERFORMANCE_EXPECTED_ROWS, FCT_AD_PERFORMANCE_TOLERANCE)],
    }


def _together(*sets: Mapping[str, Sequence[C.Check]]) -> dict[str, list[C.Check]]:
    """Check sets by table, so that each table is scanned once for all of them."""
    out: dict[str, list[C.Check]] = {}
    for checks in sets:
        for table, listed in checks.items():
            out.setdefault(table, []).extend(listed)
    return out


def bronze_tests(tables: Mapping[str, DataFrame], now: datetime, two_pass: bool = False) -> DataFrame:
    """The declared tests and the freshness of the landed tables, in one pass over each (see `checks.run_checks`)."""
    declared = declared_checks([t for t in SOURCE_TESTS if t[0] in tables], tables)
    return C.run_many(dict(tables), _together(declared, freshness_checks(tables, now)), two_pass)


def from_footers(lake: Lake, checks: Mapping[str, Sequence[C.Check]]) -> DataFrame:
    """Row-count, freshness and staleness checks of published tables ("layer.name"), without reading their rows."""
    parts = []
    for full, listed in checks.items():
        layer, name = full.split(".")
        parts.append(C.run_on_stats(lake.stats(layer, name, C.latest_columns(listed)), name, listed))
    return reduce(DataFrame.unionByName, parts)


def published_state(now: datetime) -> dict[str, list[C.Check]]:
    """By "layer.name": freshness of Bronze, and the row counts that the published marts must have."""
    out = {f"bronze.{t}": [C.freshness(col, warn, err, now)] for t, (col, warn, err) in SOURCE_FRESHNESS.items()}
    for t, listed in asset_checks().items():
        out[f"gold.{t}"] = [c for c in listed if c.kind in C.COUNT_KINDS]
    return out


def mart_tests(marts: Mapping[str, DataFrame], two_pass: bool = False) -> DataFrame:
    """The declared tests and the asset checks of the marts, in one pass over each (see `checks.run_checks`)."""
    return C.run_many(dict(marts), _together(declared_checks(MART_TESTS, marts), asset_checks()), two_pass)
