"""Query catalogue: each registered query is a Spark plan over the driver
tables plus (when SQL can express it) the DuckDB oracle statement that must
return the same rows.

Compared outputs follow fixed hygiene: timestamps as epoch microseconds,
means and deviations rounded to 6 digits, arrays and maps rendered as text,
counts as BIGINT.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}

_MODULES = (
    "driftwood.plans.q_calls",
    "driftwood.plans.q_timestamps",
    "driftwood.plans.q_windows",
    "driftwood.plans.q_messages",
    "driftwood.plans.q_normalize",
    "driftwood.plans.q_quality",
    "driftwood.plans.q_monitoring",
    "driftwood.plans.q_streaming",
    "driftwood.plans.q_ml",
    "driftwood.plans.q_io",
)


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load_all() -> None:
    for mod in _MODULES:
        importlib.import_module(mod)


def sql_round(expr: str, digits: int) -> str:
    """DuckDB expression rounding like Spark's ``round`` on DOUBLE: HALF_UP
    applied to the shortest decimal text of the value."""
    return (f"CAST(round(CAST(CAST(({expr}) AS VARCHAR) AS DECIMAL(38,18)), {digits})"
            f" AS DOUBLE)")


def r6(col):
    """Spark side of the comparison rounding: first to 9 digits (removes the
    summation-order noise of floating sums), then to 6."""
    from pyspark.sql import functions as F
    c = F.col(col) if isinstance(col, str) else col
    return F.round(F.round(c, 9), 6)


def sql_r6(expr: str) -> str:
    return sql_round(sql_round(expr, 9), 6)


def with_views(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"
