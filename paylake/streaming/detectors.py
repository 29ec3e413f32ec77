"""Live detectors that flag exactly what the batch detectors flag (T7: R1, R2, R5).

A detector looks back over one window width from each transaction. Live rows arrive out of
order, so a transaction is decided when no earlier one can arrive any more: when the
watermark (latest event time seen, less the delay) has passed it. Between micro-batches a
detector keeps a *tail*, the rows from one width before the watermark on; its size follows
the rate of rows, the width and the delay, not history. A micro-batch

* sets aside rows older than the watermark (``late``) or without a time (``no_time``), which
  go to a side output;
* runs the batch detector over the tail and the new rows and emits the flagged rows between
  the old and the new watermark, once and for good;
* writes the next tail and watermark as a new version.

Everything is written under the batch's name, and a batch reads the version before its own,
so a replay repeats the same result. What is not decided yet can be looked at with
:func:`undecided`.
"""
from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from paylake.operators import fraud
from paylake.sources import commits
from paylake.sources.commits import read_or_empty
from paylake.streaming.landing import batch_name

# what any of the detectors reads
FIELDS = ("txn_id bigint, client_id bigint, amount decimal(14,2), currency string, channel string, "
          "initiated_at timestamp_ntz")
COLUMNS = [f.strip().split(" ")[0] for f in FIELDS.replace("(14,2)", "").split(",")]
MARK = "watermark timestamp_ntz"


@dataclass(frozen=True)
class Detector:
    """A batch detector and the width it looks back."""
    detect: Callable[[DataFrame], DataFrame]
    width_s: int


VELOCITY = Detector(fraud.velocity_burst, 600)
CARD_TESTING = Detector(fraud.card_testing, 900)
SPREE = Detector(fraud.international_spree, 135 * 60)


def _seconds(n: int):
    return F.make_dt_interval(secs=F.lit(float(n)))


def _version(spark: SparkSession, state: str, number: int):
    """(tail, watermark or None) of a version; before the first there is nothing."""
    tail = read_or_empty(spark, f"{state}/tail/{number}", FIELDS)
    mark = read_or_empty(spark, f"{state}/mark/{number}", MARK).first()
    return tail, mark and mark[0]


def start(spark: SparkSession, detector: Detector, source: DataFrame, out: str, late: str, state_root: str,
          checkpoint: str, delay_s: int = 900, available_now: bool = True, every: str = "30 seconds") -> StreamingQuery:
    """Run ``detector`` over the streaming ``source`` (columns of ``FIELDS`` at least). Flagged
    rows are appended to ``out``, rows set aside with their ``reason`` to ``late``, both under the
    batch's name. The state below ``state_root`` belongs to the checkpoint's query."""

    def run(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        name = batch_name(session, checkpoint, batch_id)
        state = f"{state_root}/{commits.query_id(session, checkpoint)}"
        tail, old = _version(session, state, batch_id - 1)
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        at = F.col("initiated_at")
        seen = batch.select(F.max(at) - _seconds(delay_s)).first()[0]
        new = max([m for m in (old, seen) if m is not None], default=None)
        past = F.lit(False) if old is None else at < commits.ntz(old)
        reason = F.when(at.isNull(), "no_time").when(past, "late")
        aside = batch.withColumn("reason", reason).filter(F.col("reason").isNotNull())
        rows = tail.unionByName(batch.filter(at.isNotNull() & ~past))
        found = detector.detect(rows)
        if new is not None:
            decided = at < commits.ntz(new)
            found = found.filter(decided if old is None else decided & (at >= commits.ntz(old)))
            rows = rows.filter(at >= commits.ntz(new) - _seconds(detector.width_s))
            session.createDataFrame([(new,)], MARK).coalesce(1).write.mode("overwrite").parquet(f"{state}/mark/{batch_id}")
        rows.write.mode("overwrite").parquet(f"{state}/tail/{batch_id}")
        for df, path in ((found, out), (aside, late)):
            (df.withColumn("batch", F.lit(name)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
               .partitionBy("batch").parquet(path))
        batch.unpersist()
        for kind in ("tail", "mark"):   # a replay of this batch reads the version before it, no older one
            commits.remove(session, f"{state}/{kind}/{batch_id - 2}")

    w = (source.select(*COLUMNS).writeStream.foreachBatch(run).option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=every)
    return w.start()


def undecided(spark: SparkSession, detector: Detector, state_root: str, checkpoint: str) -> DataFrame:
    """Rows that would be flagged if nothing more arrived: those from the watermark on. With the
    emitted rows they are the batch detector's result over all rows that were not set aside."""
    state = f"{state_root}/{commits.query_id(spark, checkpoint)}"
    last = spark.read.text(f"{checkpoint}/commits").select(F.max(F.regexp_extract(
        F.col("_metadata.file_path"), "/([0-9]+)$", 1).cast("int"))).first()[0]
    tail, mark = _version(spark, state, last if last is not None else -1)
    found = detector.detect(tail)
    return found if mark is None else found.filter(F.col("initiated_at") >= commits.ntz(mark))


def read_flagged(spark: SparkSession, detector: Detector, out: str) -> DataFrame:
    """What has been emitted so far; an empty table with the same columns if nothing was."""
    schema = detector.detect(spark.createDataFrame([], FIELDS)).schema
    return read_or_empty(spark, out, schema).select(*schema.names)


def read_aside(spark: SparkSession, late: str) -> DataFrame:
    """Rows set aside so far, with the reason."""
    return read_or_empty(spark, late, FIELDS + ", reason string").select(*COLUMNS, "reason")
