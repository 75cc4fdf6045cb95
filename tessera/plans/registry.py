"""Registered queries: one per operator of the inventory, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the driver's test tables (or data Spark derives from them
and writes under the session's checkpoint folder), so its work grows with the
scale factor. ``ORACLE_SQL`` holds the DuckDB statement each one must equal.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    """Decorator: add a query (and its DuckDB oracle, if SQL can state it)."""
    def wrap(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE_SQL[name] = oracle.strip()
        return fn
    return wrap


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def load_all() -> None:
    """Import the modules that register queries."""
    from tessera.plans import (q_combine, q_copying, q_items, q_keyed, q_serialized,  # noqa: F401
                               q_sinks, q_sources)
