"""Named queries: a Spark plan per name, plus DuckDB oracle SQL where the
result is SQL-expressible. Every query reads the driver tables of ``sf_dir``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name`` (+ oracle SQL)."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load_all() -> None:
    """Import every query module (registration happens at import)."""
    for mod in ("clean_q", "profile_q", "stats_q", "eval_q", "prep_q", "cluster_q", "model_q"):
        try:
            __import__(f"tabmine.plans.{mod}")
        except ModuleNotFoundError as e:  # modules land one by one
            if e.name != f"tabmine.plans.{mod}":
                raise
