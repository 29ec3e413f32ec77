"""Full extracts by even key ranges, and typed reading of text columns with a quarantine."""
from __future__ import annotations

from collections.abc import Callable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylake.operators.ingest import union

BAD_CAST = "bad_cast"


def split_points(df: DataFrame, key: str, ranges: int) -> list:
    """At most ``ranges`` - 1 key values that part the rows evenly, from a quantile sketch of the key
    (one pass, merged from all tasks). Its rank error is a hundredth of a range, so gaps, skew
    and far outliers in the key's values do not make ranges uneven. Nulls are not counted."""
    shares = [i / ranges for i in range(1, ranges)]
    found = df.agg(F.percentile_approx(key, shares, 100 * ranges)).first()[0] if shares else None
    return sorted(set(found or []))


def range_predicates(key: str, points: list, quote=repr) -> list[str]:
    """One SQL predicate per range, and one for rows without a key; each row meets exactly one.
    They are the ``predicates`` of a partitioned read (one query per range, no offsets)."""
    if not points:
        return [f"{key} IS NOT NULL", f"{key} IS NULL"]
    inner = [f"{key} > {quote(a)} AND {key} <= {quote(b)}" for a, b in zip(points, points[1:])]
    return [f"{key} <= {quote(points[0])}", *inner, f"{key} > {quote(points[-1])}", f"{key} IS NULL"]


def range_of(key: Column, points: list) -> Column:
    """Number of the range that a key falls into (null key: -1), by halving."""
    def pick(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(key <= F.lit(points[mid]), pick(lo, mid)).otherwise(pick(mid + 1, hi))
    return F.when(key.isNull(), F.lit(-1)).otherwise(pick(0, len(points)))


def by_ranges(df: DataFrame, key: str, ranges: int) -> DataFrame:
    """``df`` with the number of its key range as ``key_range``: the full extract of a table in
    parts of even size, one per writer task or file."""
    return df.withColumn("key_range", range_of(F.col(key), split_points(df, key, ranges)))


def cast_split(df: DataFrame, schema: T.StructType,
               read_as: Callable[[Column, T.DataType, T.DataType], Column] = lambda c, _, want: c.try_cast(want),
               ) -> tuple[DataFrame, DataFrame]:
    """Rows of text columns as typed rows of ``schema``, and those that cannot be.

    Every column of ``schema`` is read with ``try_cast``, so a bad value never fails the query.
    A row with a value that is there and cannot be read goes whole to the quarantine: its
    columns as JSON (``value``), and the reason ``bad_cast:<fields>``. Columns that ``df`` lacks
    are null. One pass each; the sides are taken by an explode, so the casts run once per row."""
    have = set(df.columns)
    cast = {f.name: read_as(F.col(f.name), df.schema[f.name].dataType, f.dataType) if f.name in have else F.lit(None).cast(f.dataType) for f in schema.fields}
    bad = F.array_compact(F.array(*[F.when(F.col(n).isNotNull() & c.isNull(), F.lit(n)) for n, c in cast.items() if n in have]))
    read = df.select(F.struct(*[c.alias(n) for n, c in cast.items()]).alias("typed"), bad.alias("bad"),
                     F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value"))
    good = read.select(F.explode(F.when(F.size("bad") == 0, F.array("typed"))).alias("r")).select("r.*")
    rest = read.select(F.explode(F.when(F.size("bad") > 0, F.array(F.struct("value", "bad")))).alias("r"))
    return good, rest.select("r.value", F.concat_ws(":", F.lit(BAD_CAST), F.array_join("r.bad", ",")).alias("error_msg"))


def _lossless(c: Column, have: T.DataType, want: T.DataType) -> Column:
    """``c`` as ``want`` if that changes nothing (3.0 is the whole number 3, 2.5 is none), else null."""
    cast = c.try_cast(want)
    if have == want or isinstance(have, T.StringType):
        return cast     # a text has many forms of one value
    return F.when(cast.try_cast(have) == c, cast)


def schema_groups(spark: SparkSession, folders: Sequence[str]) -> list[tuple[T.StructType, list[str]]]:
    """Folders of raw files, those of one physical schema together. A folder whose files differ
    among themselves is taken file by file. Only footers are read."""
    groups: dict[str, tuple[T.StructType, list[str]]] = {}

    def place(path: str) -> None:
        found = spark.read.option("mergeSchema", "true").option("recursiveFileLookup", "true").parquet(path).schema
        groups.setdefault(found.json(), (found, []))[1].append(path)

    for folder in folders:
        try:
            place(folder)
        except (PySparkException, Py4JJavaError) as e:
            if "CANNOT_MERGE_SCHEMAS" not in str(e):
                raise
            files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
            for r in files.load(folder).select("path").collect():
                place(r.path)
    return list(groups.values())


def read_reconciled(spark: SparkSession, folders: Sequence[str], schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Raw files whose column types differ, as rows of ``schema`` (P9): a writer that infers types
    makes a whole-number column a floating one where it has nulls, or a time a text. Each group
    of files of one physical schema is read as it is and cast; a missing column is null. Rows with
    a value that the schema's type cannot hold unchanged go to the quarantine, as in :func:`cast_split`."""
    sides = []
    for found, paths in schema_groups(spark, folders):
        df = spark.read.schema(found).option("recursiveFileLookup", "true").parquet(*paths)
        sides.append(cast_split(df, schema, _lossless))
    return union([good for good, _ in sides]), union([bad for _, bad in sides])
