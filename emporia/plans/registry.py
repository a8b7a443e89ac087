"""Registry of named queries over the test-data tables.

Each entry pairs a Spark callable ``(spark, sf_dir) -> DataFrame`` with the
DuckDB oracle SQL for the same result (or ``None`` when the operator is not
expressible in SQL and is tested against brute force instead). Parameters
that the TD scale needs (bounds, tier cuts, a chosen customer) are fixed
here, next to both forms, so the two always use the same values.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from emporia.sources.tables import Tables


@dataclass
class Query:
    key: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    doc: str = ""


REGISTRY: dict[str, Query] = {}


def register(key: str, sql: str | None, doc: str = ""):
    """Decorator: the function receives a ``Tables`` for the sf_dir."""
    def deco(fn: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Tables(spark, sf_dir))
        run.__name__ = key
        run.__doc__ = fn.__doc__
        if key in REGISTRY:
            raise KeyError(f"duplicate query key {key}")
        REGISTRY[key] = Query(key, run, sql, doc or (fn.__doc__ or "").strip())
        return fn
    return deco


def load_all() -> dict[str, Query]:
    # Importing the plan modules fills REGISTRY.
    from emporia.plans import (  # noqa: F401
        q_catalog, q_orders, q_loyalty, q_promos, q_checks, q_versions, q_cart, q_activity, q_access, q_store,
    )
    return REGISTRY
