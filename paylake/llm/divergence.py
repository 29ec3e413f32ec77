"""Source divergence audit: how far the term use of each source lies from the others of its language.

Within a language the terms of enough documents are kept. A (language, source) group gives
each kept term a smoothed share in billionths; two groups differ by the sum of the absolute
differences over all kept terms.

Pairs are priced by a sparse merge. Kept terms have ids in blocks of bounded size; a group
has one sorted (term id, count) array per block. A task takes one unordered pair of groups
and one block: it finds the terms of both by galloping the shorter array through the
longer, prices these overlaps, then the terms of one side against the other's share of an
absent term, then the terms absent on both sides, all of one price. The sum is the same
both ways, so each pair's total is reported for both groups.

Arithmetic is exact: shares come from integer division in three steps of a thousand, sums
are of 64-bit integers.
"""
from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paylake.llm.common import settle, ship

LEAST_DOCS = 30         # documents of a language that a kept term occurs in
TOP_TERMS = 50          # terms reported of each group
SMOOTHING = 5           # added to every count
STEPS = 3               # a share is in units of 1000**-STEPS
BLOCK_TERMS = 4_096     # terms of a block, about
HELD_TERMS = 400_000    # (group, term) counts a task holds before it passes them on
# ASCII letters and all bytes of letters beyond ASCII, of text in lower case
TERM = re.compile(rb"[a-z\x80-\xff]+")


def count_terms(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """(lang, source, term, n, docs): occurrences of every term and documents with it, added up
    within each task before the shuffle. Null text, language and source count as empty."""
    ship(docs.sparkSession)

    def rows(group: tuple[str, str], uses: Counter, found_in: Counter) -> pa.RecordBatch:
        lang_, source_ = (pa.repeat(pa.scalar(g, pa.string()), len(uses)) for g in group)
        terms = list(uses)
        return pa.RecordBatch.from_arrays(
            [lang_, source_, pa.array(terms, pa.binary()).cast(pa.string()), pa.array(uses.values(), pa.int64()),
             pa.array(map(found_in.__getitem__, terms), pa.int64())], ["lang", "source", "term", "n", "docs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        size = 0
        for batch in batches:
            for a, b, t in zip(*(batch.column(i) for i in range(3))):
                uses, found_in = held.setdefault((a.as_py(), b.as_py()), (Counter(), Counter()))
                size -= len(uses)
                terms = TERM.findall(t.as_py().encode().lower())    # bytes.lower() changes A-Z only
                uses.update(terms)
                found_in.update(set(terms))
                size += len(uses)
                if size > HELD_TERMS:
                    yield from (rows(g, *counts) for g, counts in held.items())
                    held, size = {}, 0
        yield from (rows(g, *counts) for g, counts in held.items())

    df = docs.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(n)
                       for c, n in ((lang, "lang"), (source, "source"), (text, "text"))])
    part = df.mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return part.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: Column, total: Column) -> Column:
    """1 + floor(1000**STEPS * count / total), exact for totals below 9 * 10**15."""
    whole, rest = F.lit(0).cast("long"), count
    for _ in range(STEPS):
        whole, rest = 1000 * whole + F.call_function("div", 1000 * rest, total), 1000 * rest % total
    return 1 + whole


def shares(count: np.ndarray, total: int) -> np.ndarray:
    """:func:`share` of smoothed counts, in arrays."""
    whole, rest = np.zeros(len(count), np.int64), count.astype(np.int64)
    for _ in range(STEPS):
        rest = rest * 1000
        whole, rest = whole * 1000 + rest // total, rest % total
    return whole + 1


def gallop(short: np.ndarray, long: np.ndarray, stride: int = 64) -> np.ndarray:
    """For each of ``short`` the first place in ``long`` that is not below it (both ascending).

    ``stride`` values at a time gallop on together: from the place of the last one, in doubling
    steps, until the stretch holds them all; each is then found in the stretch by halving."""
    place, low, n = np.zeros(len(short), np.int64), 0, len(long)
    for at in range(0, len(short), stride):
        values = short[at:at + stride]
        high, step, last = low, 1, values[-1]
        while high < n and long[high] < last:
            high, step = high + step, 2 * step
        place[at:at + stride] = low + long[low:high + 1].searchsorted(values)
        low = place[at + len(values) - 1]
    return place


def merge_price(a_ids: np.ndarray, a_counts: np.ndarray, a_total: int,
                b_ids: np.ndarray, b_counts: np.ndarray, b_total: int, terms: int) -> int:
    """Sum of the absolute differences of two groups' shares over the ``terms`` kept terms of
    a block, of which each group lists those it has; totals are smoothed sums."""
    if len(a_ids) > len(b_ids):
        return merge_price(b_ids, b_counts, b_total, a_ids, a_counts, a_total, terms)
    a, b = shares(a_counts + SMOOTHING, a_total), shares(b_counts + SMOOTHING, b_total)
    none = np.array([SMOOTHING])
    a_none, b_none = int(shares(none, a_total)[0]), int(shares(none, b_total)[0])
    place = gallop(a_ids, b_ids)
    both = np.zeros(len(a_ids), bool)
    inside = place < len(b_ids)
    both[inside] = b_ids[place[inside]] == a_ids[inside]
    only_b = np.ones(len(b_ids), bool)
    only_b[place[both]] = False
    absent = terms - len(a_ids) - int(only_b.sum())
    return (int(np.abs(a[both] - b[place[both]]).sum()) + int(np.abs(a[~both] - b_none).sum())
            + int(np.abs(b[only_b] - a_none).sum()) + absent * abs(a_none - b_none))


def price_pairs(left: DataFrame, right: DataFrame) -> DataFrame:
    """(lang, source, other, value) per pair and block: co-groups the arrays of two groups."""
    def run(one: pa.Table, two: pa.Table) -> pa.Table:
        def side(t):
            array = lambda c: t.column(c)[0].values.to_numpy(zero_copy_only=False)
            return array("ids"), array("counts"), t.column("total")[0].as_py()

        value = merge_price(*side(one), *side(two), one.column("terms")[0].as_py())
        return one.slice(0, 1).select(["lang", "source", "other"]).append_column("value", pa.array([value], pa.int64()))

    by = ["lang", "source", "other", "block"]
    return left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(
        run, "lang string, source string, other string, value long")


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP_TERMS,
          lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """(lang, source, part, item, value, rank) for every (lang, source) group of ``docs``.

    Part ``pair`` ranks all other sources of the language by distance; part ``term`` ranks
    the ``top`` terms that the group uses more than its language does. Nulls in language,
    source and text count as empty; a text without terms still makes its group occur;
    repeated rows are counted as often as they stand; ties are ranked by item in UTF-8
    order; an empty table gives an empty result; other columns are not read, so their
    names cannot clash. A language with one source has no pairs, one without kept terms
    has pairs of value 0. Groups are pairs by the contract, so a language of S sources
    costs S * (S - 1) / 2 merges of each block.
    """
    ship(docs.sparkSession)
    counts = settle(count_terms(docs, lang, source, text), "term-counts")
    name = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    groups = docs.select(name(lang).alias("lang"), name(source).alias("source")).distinct()
    kept = settle(counts.groupBy("lang", "term").agg(F.sum("docs").alias("d"), F.sum("n").alias("all"))
                  .filter(F.col("d") >= least_docs).drop("d"), "kept-terms")
    blocks = max(1, -(-kept.count() // BLOCK_TERMS))
    # term ids: hash blocks of bounded size, numbered within each
    kept = settle(kept.withColumn("block", F.pmod(F.xxhash64("term"), F.lit(blocks)).cast("int"))
                  .withColumn("id", F.row_number().over(Window.partitionBy("lang", "block").orderBy("term"))), "term-ids")
    sizes = kept.groupBy("lang", "block").agg(F.count("*").alias("terms"))
    langs = kept.groupBy("lang").agg((F.sum("all") + SMOOTHING * F.count("*")).alias("whole"),
                                     (SMOOTHING * F.count("*")).alias("extra"))
    used = settle(counts.join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "all", "block", "id"), "used-terms")
    totals = settle(groups.join(used.groupBy("lang", "source").agg(F.sum("n").alias("sum")), ["lang", "source"], "left")
                    .join(langs, "lang", "left")
                    .select("lang", "source", "whole", (F.coalesce("sum", F.lit(0)) + F.coalesce("extra", F.lit(0))).alias("total")),
                    "group-totals")

    terms = used.join(totals, ["lang", "source"]).select(
        "lang", "source", F.col("term").alias("item"),
        (share(F.col("n") + SMOOTHING, F.col("total")) - share(F.col("all") + SMOOTHING, F.col("whole"))).alias("value"))
    by = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = terms.filter(F.col("value") > 0).withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= top)

    # every group has an array in every block of its language, if only an empty one
    empty = F.array().cast("array<struct<id:int,n:bigint>>")
    arrays = (used.groupBy("lang", "source", "block").agg(F.sort_array(F.collect_list(F.struct("id", "n"))).alias("x")))
    arrays = (totals.join(sizes, "lang").join(arrays, ["lang", "source", "block"], "left")
              .withColumn("x", F.coalesce("x", empty))
              .select("lang", "source", "block", "terms", "total", F.col("x.id").alias("ids"), F.col("x.n").alias("counts")))
    arrays = settle(arrays, "term-arrays")
    pairs = (groups.alias("g").join(groups.withColumnRenamed("source", "other").alias("o"), "lang")
             .filter(F.col("source") < F.col("other")))
    left = arrays.join(pairs, ["lang", "source"])
    # columns of their own: both sides come from the same two tables
    fresh = lambda df: df.toDF(*df.columns)
    right = fresh(fresh(arrays).withColumnRenamed("source", "other").join(fresh(pairs), ["lang", "other"]))
    priced = price_pairs(left, right).groupBy("lang", "source", "other").agg(F.sum("value").alias("value"))
    priced = settle(pairs.join(priced, ["lang", "source", "other"], "left")
                    .select("lang", "source", "other", F.coalesce("value", F.lit(0)).cast("long").alias("value")), "pair-values")
    both = priced.unionAll(priced.select("lang", F.col("other").alias("source"), F.col("source").alias("other"), "value"))
    ranked = both.withColumnRenamed("other", "item").withColumn("rank", F.row_number().over(by))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return (ranked.withColumn("part", F.lit("pair")).select(columns)
            .unionAll(terms.withColumn("part", F.lit("term")).select(columns)))
