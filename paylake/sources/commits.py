"""Folders that appear whole or not at all, and what is known of them.

A *load* is one folder of rows under a table. Before its rows are written an intent names
what it will hold; after they are written and checked, a commit record names what it
holds; then the intent goes. A run that dies leaves an intent, from which the next run
writes the same folder again, and readers take committed loads only. So neither recovery
nor reading ever looks through the rows of earlier loads.

Layout under the ledger's folder: ``intents/load=<name>/`` and ``commits/load=<name>/``.
"""
from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LEDGER = "file_path string, processed_at timestamp_ntz, n_rows bigint, landing_day date, load string"
INTENT = "file_path string, n_rows bigint, landing_day date, load string"


def read_or_empty(spark: SparkSession, path: str, schema: str, **options) -> DataFrame:
    """The table at ``path``, or an empty one if nothing was ever written there.
    Any other failure (permissions, a broken store) is raised, never taken for
    an empty table."""
    try:
        return spark.read.options(**options).schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def ntz(value: dt.datetime) -> Column:
    """A timestamp without zone as a literal, whatever the zones of session and machine."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def remove(spark: SparkSession, path: str) -> None:
    """Take away a folder of this package's own, on whatever store it is (missing: nothing to do)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the streaming query that owns ``checkpoint``: it stays over restarts, and a
    new checkpoint has a new one. With the number of a batch it names that batch."""
    text = spark.read.text(f"{checkpoint}/metadata").first()[0]
    return spark.range(1).select(F.get_json_object(F.lit(text), "$.id")).first()[0]


def read_commits(spark: SparkSession, ledger: str, since: dt.date | None = None) -> DataFrame:
    """One row per loaded file; with ``since``, of landing days from then on (pushed to the scan)."""
    done = read_or_empty(spark, f"{ledger}/commits", LEDGER)
    return done if since is None else done.filter(F.col("landing_day") >= F.lit(since))


def pending(spark: SparkSession, ledger: str) -> list[str]:
    """Names of loads begun and not committed. Intents of committed loads go at the commit, so
    these are few: one for each run that died."""
    begun = read_or_empty(spark, f"{ledger}/intents", INTENT).select("load").distinct()
    out = []
    for r in begun.collect():
        if committed(spark, ledger, r.load):    # died between its commit and taking the intent away
            remove(spark, f"{ledger}/intents/load={r.load}")
        else:
            out.append(r.load)
    return sorted(out)


def committed(spark: SparkSession, ledger: str, load: str) -> bool:
    return not read_or_empty(spark, f"{ledger}/commits/load={load}/", "file_path string").isEmpty()


def begin(files: DataFrame, ledger: str, load: str) -> DataFrame:
    """Record what the load will hold (file_path, n_rows, landing_day) and return the record."""
    path = f"{ledger}/intents/load={load}"
    files.select("file_path", "n_rows", "landing_day").write.mode("overwrite").parquet(path)
    return intent(files.sparkSession, ledger, load)


def intent(spark: SparkSession, ledger: str, load: str) -> DataFrame:
    return spark.read.schema("file_path string, n_rows bigint, landing_day date").parquet(f"{ledger}/intents/load={load}")


def commit(files: DataFrame, ledger: str, load: str, at) -> None:
    """Record the files (file_path, n_rows, landing_day) as loaded, then end the intent. The
    record is one file, so it is there or not."""
    spark = files.sparkSession
    (files.select("file_path", at.alias("processed_at"), "n_rows", "landing_day").coalesce(1)
          .write.mode("overwrite").parquet(f"{ledger}/commits/load={load}"))
    remove(spark, f"{ledger}/intents/load={load}")


def read_loads(spark: SparkSession, target: str, ledger: str, schema=None) -> DataFrame:
    """The rows of all committed loads of ``target``."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    loads = read_commits(spark, ledger).select("load").distinct()
    return reader.parquet(target).join(loads, "load", "left_semi")
