"""Lazy access to the driver's parquet tables."""
from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
                 "lineitem", "events")


class Tables:
    """``Tables(spark, sf_dir).lineitem`` -> DataFrame, read once per object.

    Reads are plain ``spark.read.parquet``: Catalyst prunes columns and pushes
    filters into each scan, so callers select only what they need.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        if name in DRIVER_TABLES:
            df = self.read(name)
            self.__dict__[name] = df
            return df
        raise AttributeError(name)

    @cached_property
    def raw(self):
        from paylake.sources.adapters import RawTables
        return RawTables(self)
