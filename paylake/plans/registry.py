"""Registration of queries: ``QUERIES[key](spark, sf_dir) -> DataFrame`` and the
matching DuckDB oracle text ``ORACLES[key]``. The query modules import this one;
:mod:`paylake.plans.catalog` imports them all.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from paylake.operators.warehouse import Operations, Warehouse
from paylake.plans import oracle_models  # noqa: F401  (registers model CTEs)
from paylake.plans.oracle_base import with_ctes
from paylake.session import configure
from paylake.sources.tables import Tables

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    configure(spark)
    return Operations(Tables(spark, sf_dir))


def query(key: str, oracle: str | None = None):
    """Register a Spark query under ``key`` with an optional oracle SQL."""
    def deco(fn: Query) -> Query:
        QUERIES[key] = fn
        if oracle is not None:
            ORACLES[key] = oracle
        return fn
    return deco
