"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the driver's tables (or the loan view Spark derives from
them) in full. Where an equivalent DuckDB SQL exists it is registered beside the
query under the same key, with the same column names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE_SQL: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def wrap(fn: QueryFn) -> QueryFn:
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLE_SQL[key] = sql
        return fn
    return wrap


def load_all() -> None:
    """Import the modules that register queries."""
    from lendscope.plans import queries_explore  # noqa: F401
    from lendscope.plans import queries_quality  # noqa: F401
    from lendscope.plans import queries_io  # noqa: F401
    from lendscope.plans import queries_ml  # noqa: F401
    from lendscope.plans import queries_dist  # noqa: F401
