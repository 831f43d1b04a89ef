"""Registry of named queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each entry composes library operators on the stand-in inputs built from the
given tables; the matching DuckDB SQL (when one can be written) is registered
under the same name in ``ORACLE``.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from provisio.plans.inputs import Inputs

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(inputs) -> DataFrame`` under ``name`` (and its oracle SQL)."""
    def deco(fn: Callable[[Inputs], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Inputs(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    from provisio.plans import q_cycle, q_explore, q_features, q_models, q_sinks, q_streams  # noqa: F401
