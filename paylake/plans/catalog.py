"""Query catalogue: ``QUERIES[key](spark, sf_dir) -> DataFrame`` and the
matching DuckDB oracle text ``ORACLES[key]``.

Each entry reads the driver tables under ``sf_dir`` through the adapter, so
its work grows with the tables.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from paylake.operators.warehouse import Warehouse
from paylake.plans.oracle_base import with_ctes
from paylake.plans.registry import ORACLES, QUERIES, Query, query, warehouse  # noqa: F401


def _model(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return getattr(warehouse(spark, sf_dir), name)
    run.__name__ = name
    return run


for _name in Warehouse.MODELS:
    query(_name, with_ctes([_name], f"SELECT * FROM {_name}"))(_model(_name))

# further operator families register themselves on import
from paylake.plans import queries_ops  # noqa: E402,F401
from paylake.plans import queries_stream  # noqa: E402,F401
from paylake.plans import queries_flow  # noqa: E402,F401
