"""Load state of the extracts: an append-only changelog, folded to the latest entry per table.

Entries are (seq, table_name, status, watermark, n_rows). ``completed`` marks a full load,
``watermark`` the changes read since, ``reset`` asks for a full load again. A poll reads the
folded log, extracts, and appends its entries under its own number, so the next poll goes on
where it ended; a poll that dies before that append is repeated under the same number and
overwrites what it wrote. :func:`compact` folds old entries into one snapshot.

Layout: ``<root>/log/seq=<n>/`` and ``<root>/snapshot/upto=<n>/``.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylake.operators import ingest
from paylake.sources import commits
from paylake.sources.commits import read_or_empty

ENTRY = "table_name string, status string, watermark timestamp_ntz, n_rows bigint"
LOG = f"{ENTRY}, seq int"
SNAPSHOT = f"{ENTRY}, seq int, upto int"


def entries(spark: SparkSession, root: str) -> DataFrame:
    """The newest snapshot and all entries after it."""
    snapshot = read_or_empty(spark, f"{root}/snapshot", SNAPSHOT)
    upto = snapshot.agg(F.max("upto")).first()[0]
    log = read_or_empty(spark, f"{root}/log", LOG)
    if upto is None:
        return log
    kept = snapshot.filter(F.col("upto") == upto).drop("upto")
    return kept.unionByName(log.filter(F.col("seq") > upto))


def latest(spark: SparkSession, root: str) -> DataFrame:
    """One row per table: its latest status and watermark and the number of the poll. A
    ``reset`` drops the watermark; ``watermark`` after ``completed`` leaves the table completed."""
    log = entries(spark, root)
    return (log.groupBy("table_name").agg(F.max_by(F.struct("status", "watermark"), "seq").alias("e"), F.max("seq").alias("seq"))
               .select("table_name", F.when(F.col("e.status") == "reset", "reset").otherwise("completed").alias("status"),
                       F.when(F.col("e.status") != "reset", F.col("e.watermark")).alias("watermark"), "seq"))


def append(rows: DataFrame, root: str, seq: int) -> None:
    """Record a poll's entries as one file; the poll of that number again overwrites them."""
    rows.select("table_name", "status", "watermark", "n_rows").coalesce(1).write.mode("overwrite").parquet(f"{root}/log/seq={seq}")


def next_seq(spark: SparkSession, root: str) -> int:
    """The number of the next poll: one after the last that was recorded."""
    last = entries(spark, root).agg(F.max("seq")).first()[0]
    return 0 if last is None else last + 1


def reset(spark: SparkSession, root: str, tables: Sequence[str]) -> None:
    """Ask for a full load of ``tables`` at the next poll."""
    rows = spark.createDataFrame([(t, "reset", None, 0) for t in tables], ENTRY)
    append(rows, root, next_seq(spark, root))


def compact(spark: SparkSession, root: str) -> None:
    """Fold the log into one snapshot of the latest entry per table, then drop the entries it
    holds. A compaction that dies leaves a snapshot or entries that the next read passes over."""
    last = next_seq(spark, root) - 1
    if last < 0:
        return
    log = entries(spark, root)
    fold = log.groupBy("table_name").agg(F.max_by(F.struct("status", "watermark", "n_rows"), "seq").alias("e"), F.max("seq").alias("seq"))
    fold.select("table_name", "e.*", "seq").coalesce(1).write.mode("overwrite").parquet(f"{root}/snapshot/upto={last}")
    for r in read_or_empty(spark, f"{root}/log", LOG).filter(F.col("seq") <= last).select("seq").distinct().collect():
        commits.remove(spark, f"{root}/log/seq={r.seq}")
    for r in read_or_empty(spark, f"{root}/snapshot", SNAPSHOT).filter(F.col("upto") < last).select("upto").distinct().collect():
        commits.remove(spark, f"{root}/snapshot/upto={r.upto}")


def poll(spark: SparkSession, tables: dict[str, DataFrame], watermarks: dict[str, str | None], root: str, out: str) -> int:
    """One poll of ``tables`` (S2, S4, S5, A8, K10, T2): a table that is not completed is loaded
    whole (op ``r``), a completed one with a watermark column gives the rows from its watermark
    on (op ``c``; inclusive, so rows of the same second are not lost and are read again; a
    load by key absorbs them), a completed one without such a column gives nothing.

    Extracts go to ``<out>/table_name=<t>/poll=<n>``, then one entry per table that was read
    to the log. Returns the poll's number. The folded state is read on the driver: one row
    per table of the catalogue."""
    state = {r.table_name: r for r in latest(spark, root).collect()}
    seq, done = next_seq(spark, root), []
    for table, df in tables.items():
        known, wm = state.get(table), watermarks.get(table)
        full = known is None or known.status != "completed"
        if not full and wm is None:
            continue
        since = None if full else known.watermark
        rows = df if since is None else df.filter(F.col(wm) >= commits.ntz(since).cast(df.schema[wm].dataType))
        path = f"{out}/table_name={table}/poll={seq}"
        rows.withColumn("op", F.lit("r" if full else "c")).write.mode("overwrite").parquet(path)
        # what was written is what counts: one pass over two columns of it
        mark = F.max(wm).cast("timestamp_ntz") if wm else F.lit(None).cast("timestamp_ntz")
        before = F.lit(None).cast("timestamp_ntz") if since is None else commits.ntz(since)
        seen = read_or_empty(spark, path, df.schema).agg(F.count(F.lit(1)).alias("n_rows"), mark.alias("m"))
        done.append(seen.select(F.lit(table).alias("table_name"), F.lit("completed" if full else "watermark").alias("status"),
                                F.greatest("m", before).alias("watermark"), "n_rows"))
    if done:
        append(ingest.union(done), root, seq)
    return seq
