"""Registered queries: one Spark plan per operator plus its DuckDB oracle.

Each entry maps a name to ``(fn(spark, sf_dir) -> DataFrame, sql | None)``.
``sql`` is None for operators whose result is not expressible in SQL
(k-means, streaming, schema listing); those get a rows-only check.
Every query reads the generated tables (through ``Inputs``) in full.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from reviewlake.plans.inputs import Inputs

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Callable[[Inputs], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Inputs(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        REGISTRY[name] = (run, sql)
        return fn
    return deco


def queries() -> dict[str, QueryFn]:
    _load()
    return {k: v[0] for k, v in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load()
    return {k: v[1] for k, v in REGISTRY.items() if v[1] is not None}


def _load():
    # Importing the modules registers their queries.
    from reviewlake.plans import (q_quality, q_reviews, q_text, q_users,  # noqa: F401
                                  q_ingest, q_monitoring, q_ml)
