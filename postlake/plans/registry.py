"""Query registry.

Every registered query is a function ``(spark, sf_dir) -> DataFrame`` over the
driver tables (or views Spark derives from them).  ``sql`` is the DuckDB
oracle over the same tables; ``None`` means no SQL form (rows-only check).
"""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_SQL: dict[str, str] = {}

_MODULES = (
    "postlake.plans.q_topics",
    "postlake.plans.q_ingest",
    "postlake.plans.q_text",
    "postlake.plans.q_vectors",
    "postlake.plans.q_tables",
    "postlake.plans.q_sketches",
    "postlake.plans.q_bot",
    "postlake.plans.q_streaming",
)


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in _QUERIES:
            raise ValueError(f"duplicate query {name}")
        _QUERIES[name] = fn
        if sql is not None:
            _SQL[name] = sql
        return fn
    return deco


def _load() -> None:
    for m in _MODULES:
        importlib.import_module(m)


def _utc(fn: QueryFn) -> QueryFn:
    """Fixture timestamps are wall-clock (TIMESTAMP_NTZ); casts to session
    timestamps (watermarks, epoch micros) must not shift them, so every
    query runs with a UTC session time zone."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return fn(spark, sf_dir)
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def all_queries() -> dict[str, QueryFn]:
    _load()
    return {k: _utc(v) for k, v in _QUERIES.items()}


def all_oracle_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)
