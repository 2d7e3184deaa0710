"""Name -> (Spark query, oracle SQL) registry."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}


def register(name: str, sql: str | None):
    """Register ``fn(spark, sf_dir)`` under ``name`` with its oracle SQL
    (``None`` when the operator is not expressible in SQL)."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"query {name} registered twice")
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


# Session settings the queries rely on: wall-clock (UTC) text of instants and
# the TIME type.  Applied before each query is built, so a session made
# elsewhere (a driver, a notebook) gives the same results.
REQUIRED_CONF = {"spark.sql.session.timeZone": "UTC", "spark.sql.timeType.enabled": "true"}


def _prepared(fn: QueryFn) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        for k, v in REQUIRED_CONF.items():
            if spark.conf.get(k, None) != v:
                spark.conf.set(k, v)
        return fn(spark, sf_dir)
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def queries() -> dict[str, QueryFn]:
    return {k: _prepared(v[0]) for k, v in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v[1] for k, v in REGISTRY.items() if v[1] is not None}
