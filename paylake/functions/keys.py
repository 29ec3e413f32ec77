"""Keyed deduplication and unknown-member rows."""
from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
                   ties: Sequence[str] | None = None) -> DataFrame:
    """Keep the first row per key under ``order``; ``ties`` break equal
    orders deterministically (descending, NULLs last), so every engine keeps
    the same row (N11). By default all non-key columns are tie-breaks.

    Planned as ``row_number() = 1``: Spark adds a partial
    ``WindowGroupLimit`` before the shuffle, so a hot key is cut to one row
    per input partition map-side and never lands whole in one task.
    """
    if ties is None:
        ties = [c for c in df.columns if c not in keys]
    spec = Window.partitionBy(*keys).orderBy(*order, *[F.col(c).desc_nulls_last() for c in ties])
    return (df.withColumn("_rn", F.row_number().over(spec))
              .filter(F.col("_rn") == 1).drop("_rn"))


DOUBT_WORDS = 1 << 18    # buckets of keys that the narrow pass leaves undecided, 64 in a word: bounds their broadcast


def _bucket(key: Sequence[Column]) -> tuple[Column, Column]:
    """The bucket of a key as a word and one bit of it."""
    h = F.xxhash64(*key)
    # the highest six bits number the bit; all others but the word's are free
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.shiftrightunsigned(h, 58).cast("int"))
    return h.bitwiseAND(F.lit(DOUBT_WORDS - 1)), bit


def latest_columns(df: DataFrame, keys: Sequence[str], order: Sequence[Column], columns: Sequence[str],
                   among: Callable[[Callable[..., DataFrame]], DataFrame] | None = None) -> DataFrame:
    """``latest_per_key(df, keys, order)`` with ``keys`` and ``columns`` alone, without shuffling whole rows.

    The narrow pass carries keys, ``columns`` and what ``order`` reads, and keeps the first rows of each
    key with their ties. Ties that agree in ``columns`` need no tie-break. Keys whose ties differ
    fall into hash buckets, ``64 * DOUBT_WORDS`` at most; the rows of those buckets alone go whole through
    :func:`latest_per_key`, whatever their number. Ties of one key meet in one task.

    Where ``df`` is a view over joins, ``among(only)`` gives the rows of ``df`` made from sources that it has
    reduced by ``only(source, *key)``, before they are joined: the whole rows then cost no second join of all rows.
    """
    cols = [c for c in columns if c not in keys]
    first = df.withColumn("_r", F.rank().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("_r") == 1)
    row = F.struct(*[F.col(c) for c in cols]) if cols else F.struct(F.lit(1))
    word, bit = _bucket([F.col(k) for k in keys])
    one = first.select(*keys, row.alias("_row")).groupBy(*keys).agg(F.min("_row").alias("_row"), F.max("_row").alias("_high"))
    doubt = (one.filter(~F.col("_row").eqNullSafe(F.col("_high"))).select(word.alias("_word"), bit.alias("_bit"))
             .groupBy("_word").agg(F.bit_or("_bit").alias("_bits")))

    def joined(rows: DataFrame, key: Sequence[Column], how: str) -> DataFrame:
        word, bit = _bucket(key)
        return rows.join(F.broadcast(doubt), (word == F.col("_word")) & (F.col("_bits").bitwiseAND(bit) != 0), how)

    def only(rows: DataFrame, *key: Column) -> DataFrame:
        return joined(rows, key, "left_semi")

    at = [F.col(k) for k in keys]
    sure = joined(one, at, "left_anti").select(*keys, *[F.col(f"_row.{c}") for c in cols])
    whole = among(only) if among else only(df, *at)
    return sure.unionByName(latest_per_key(whole, keys, order).select(*keys, *cols))


def unknown_member(spark: SparkSession, like: DataFrame, values: dict) -> DataFrame:
    """A one-row frame with ``like``'s schema: given values, typed NULLs
    elsewhere (the ``-1`` member that null fact keys join to)."""
    cols = [F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in like.schema.fields]
    return spark.range(1).select(*cols)
