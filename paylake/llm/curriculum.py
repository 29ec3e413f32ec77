"""Mixing sources to target weights along a time-varying curriculum.

Every source has a weight schedule over training time 0..1. Its integral is the
source's target; the cumulative demand curve, inverted, turns a document's place
in its source (in words) into a training time. Documents are then range-sorted
by that time.

Prefix sums inside a source run over (source, hash bucket) groups: a source with
a third of all rows spreads over the buckets, and only one row per bucket meets
its source's other buckets.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paylake.llm.common import SPACE_CLASS

BUCKET_DIGITS = 3  # hexadecimal digits of the hash: 4,096 buckets a source


@dataclass(frozen=True)
class Schedule:
    """The weight ``weight * (1 + tilt * (1 - 2 t))`` at time t: falling for a positive
    tilt (-1..1), rising for a negative one. Its integral over 0..1 is ``weight``."""
    weight: float
    tilt: float = 0.0


SCHEDULES = (Schedule(5.0, 0.5), Schedule(2.0, 0.0), Schedule(1.0, -0.5))


def size_of(text: Column) -> Column:
    """Words of a text (null: none)."""
    return F.coalesce(F.size(F.array_remove(F.split(text, SPACE_CLASS), "")), F.lit(0)).cast("long")


def _pick(schedules: tuple[Schedule, ...], field: str, rank: Column) -> Column:
    values = F.array(*[F.lit(float(getattr(s, field))) for s in schedules])
    return F.get(values, ((rank - 1) % len(schedules)).cast("int"))


def targets(totals: DataFrame, schedules: tuple[Schedule, ...], most: float) -> DataFrame:
    """Target words of each source: water-filling of the total by weight under the
    cap ``most`` times the source. ``totals`` has one row per source (_s, source_size);
    its windows are over sources, not documents."""
    whole = Window.partitionBy()
    df = totals.select("_s", "source_size", F.row_number().over(whole.orderBy("_s")).alias("_rank"),
                       F.sum("source_size").over(whole).alias("_all"))
    df = df.select("*", _pick(schedules, "weight", F.col("_rank")).alias("_w"),
                   _pick(schedules, "tilt", F.col("_rank")).alias("_tilt"),
                   (F.lit(most) * F.col("source_size")).alias("_cap"))
    # by the level at which a source reaches its cap: those before are full
    order = whole.orderBy(F.col("_cap") / F.col("_w"), "_rank")
    full = F.coalesce(F.sum("_cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    weight = F.sum("_w").over(order.rowsBetween(0, Window.unboundedFollowing))
    df = df.select("*", ((F.col("_all") - full) / weight).alias("_level"), F.row_number().over(order).alias("_n"))
    fits = F.col("_level") <= F.col("_cap") / F.col("_w")
    df = df.select("*", F.min(F.when(fits, F.struct("_n", "_level"))).over(whole)["_level"].alias("_fill"))
    return df.select("_s", "source_size", "_tilt", F.when(
        F.col("_fill").isNull(), F.col("_cap")).otherwise(
        F.least(F.col("_cap"), F.col("_fill") * F.col("_w"))).alias("target"))


def time_of(share: Column, tilt: Column) -> Column:
    """Training time at which the cumulative demand reaches ``share`` of its total."""
    root = F.sqrt(F.greatest((1 + tilt) * (1 + tilt) - 4 * tilt * share, F.lit(0.0)))
    return F.when(tilt == 0, share).otherwise((1 + tilt - root) / (2 * tilt))


def plan(docs: DataFrame, schedules: tuple[Schedule, ...] = SCHEDULES, most: float = 3.0,
         key: str = "doc_id", source: str = "source", text: str = "text", keep_rows: bool = False) -> DataFrame:
    """One row per document: key, size, source_size, target, copies, times (array).

    A source's documents stand in hash order, pass after pass; those whose middle
    word lies before the target are taken, so a source misses its target by half a
    document at most. ``keep_rows`` adds the whole input row as ``_row``.

    Null text has size 0 and is never taken; a null source is a source of its own,
    last in order; a null key is placed by its text; ties (repeated rows) are
    interchangeable; an empty table gives an empty result. Working columns start
    with ``_`` and only the named columns are read, so others cannot clash.
    """
    k, s, t = (F.col(f"`{c}`") for c in (key, source, text))
    row = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")] if keep_rows else []
    place = F.md5(F.coalesce(k.cast("string"), F.concat(F.lit("null "), F.coalesce(t, F.lit("")))).cast("binary"))
    df = docs.select(k.alias("_k"), F.coalesce(F.concat(F.lit("0"), s), F.lit("1")).alias("_s"),
                     size_of(t).alias("size"), place.alias("_h"), F.xxhash64(t).alias("_x"), *row)
    df = df.withColumn("_b", F.substring("_h", 1, BUCKET_DIGITS))
    buckets = df.groupBy("_s", "_b").agg(F.sum("size").alias("_n"))
    sources = buckets.groupBy("_s").agg(F.sum("_n").alias("source_size"))
    before = Window.partitionBy("_s").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (buckets.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
               .join(targets(sources, schedules, most), "_s").drop("_n"))
    inside = Window.partitionBy("_s", "_b").orderBy("_h", "_k", "size", "_x").rowsBetween(Window.unboundedPreceding, -1)
    df = df.withColumn("_in", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    df = df.join(offsets, ["_s", "_b"])
    middle = F.col("_before") + F.col("_in") + F.col("size") / F.lit(2.0)
    copies = F.when(F.col("size") > 0, F.greatest(
        F.floor((F.col("target") - middle) / F.col("source_size")) + 1, F.lit(0))).otherwise(F.lit(0)).cast("long")
    df = df.withColumn("copies", copies).withColumn("_mid", middle)
    times = F.when(F.col("copies") > 0, F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("copies") - 1),
        lambda i: time_of((F.col("_mid") + i * F.col("source_size")) / F.col("target"), F.col("_tilt"))))
    return df.select(F.col("_k").alias(key), "size", "source_size", "target", "copies",
                     F.coalesce(times, F.array().cast("array<double>")).alias("times"),
                     *(["_row"] if keep_rows else []))


def report(docs: DataFrame, **kw) -> DataFrame:
    """The plan, range-sorted by the first training time (documents not taken last)."""
    df = plan(docs, **kw)
    df = df.withColumn("first_time", F.get("times", F.lit(0))).withColumn("taken", F.col("size") * F.col("copies"))
    order = F.coalesce(F.col("first_time"), F.lit(2.0))
    return df.repartitionByRange(order, df.columns[0]).sortWithinPartitions(order, df.columns[0])


def mix(docs: DataFrame, **kw) -> DataFrame:
    """The training order: every taken copy as a row of ``docs``, range-sorted by its time."""
    df = plan(docs, keep_rows=True, **kw).select("_row", F.explode("times").alias("_time"))
    return df.repartitionByRange("_time").sortWithinPartitions("_time").select("_row.*")
