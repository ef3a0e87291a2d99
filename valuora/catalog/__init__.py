"""Registered queries: each library operator applied to the driver's tables.

Every entry is ``name -> (callable(spark, sf_dir) -> DataFrame, oracle SQL or
None)``.  The oracle is an independent DuckDB query over the same parquet
views; entries without one are model-fitting jobs checked by pytest
properties instead.  Floating outputs are rounded (6 decimals in log space,
2 for dollars) on both sides so engine-level summation order cannot change
the value hash.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = (fn, sql)
        return fn

    return deco


def _load() -> None:
    from valuora.catalog import (  # noqa: F401
        drift_queries,
        learned_queries,
        metric_queries,
        ml_queries,
        model_queries,
        profile_queries,
        split_queries,
        stream_queries,
        table_queries,
    )


def queries() -> dict[str, QueryFn]:
    _load()
    return {k: v[0] for k, v in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load()
    return {k: v[1] for k, v in REGISTRY.items() if v[1] is not None}
