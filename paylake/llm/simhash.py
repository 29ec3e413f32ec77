"""SimHash near-duplicates by anchor-point covering.

A 64-bit fingerprint is cut into ``max_bits // 2 + 1`` blocks, so two fingerprints
within ``max_bits`` agree up to one bit in some block. The anchors of a block are
the words of a Hamming code: every value lies within distance 1 of exactly one
anchor, its home (the covering radius is 1). A fingerprint stays at its home and is
replicated to every anchor within covering radius plus threshold (1 + 1); two
fingerprints that agree up to one bit in the block then meet at the home of either.
Distances are checked per anchor.

Only distinct fingerprints take part, so copies cost nothing there. Links become
components by alternating large-star and small-star steps on tables.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylake.llm.common import ascii_lower, settle, ship, words

BITS = 64
LANES = np.uint64(0x0101010101010101)


def shingle_hashes(text: Column, size: int) -> Column:
    """XXH64 (seed 42) of every run of ``size`` words; of the whole sequence if shorter; empty if none."""
    w = F.col("_w")
    run = lambda i: F.xxhash64(F.concat_ws(" ", *[F.get(w, i + j) for j in range(size)]))
    return (F.when(F.size(w) >= size, F.transform(F.sequence(F.lit(0), F.size(w) - size), run))
            .when(F.size(w) > 0, F.array(F.xxhash64(F.concat_ws(" ", w))))
            .otherwise(F.array().cast("array<bigint>")))


def majority(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each run hashes[offsets[i]:offsets[i+1]] the word of bits set in over half of it.

    Eight counters of one byte share a 64-bit word, so runs are summed in pieces of
    255 or fewer and the pieces then added up.
    """
    sizes = np.diff(offsets)
    full = np.flatnonzero(sizes)
    out = np.zeros(len(sizes), np.uint64)
    if not len(full):
        return out
    pieces = -(-sizes[full] // 255)
    first = np.concatenate([[0], np.cumsum(pieces)[:-1]])
    starts = np.repeat(offsets[:-1][full], pieces) + 255 * (np.arange(pieces.sum()) - np.repeat(first, pieces))
    counts = np.empty((len(full), BITS), np.int64)
    for j in range(8):
        sums = np.add.reduceat((hashes >> np.uint64(j)) & LANES, starts)
        lanes = sums.astype("<u8").view(np.uint8).reshape(-1, 8).astype(np.int64)
        counts[:, j::8] = np.add.reduceat(lanes, first, axis=0)
    bits = 2 * counts > sizes[full][:, None]
    out[full] = np.packbits(bits, axis=1, bitorder="little").view("<u8").ravel()
    return out


def fingerprints(docs: DataFrame, size: int = 3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fp): the SimHash of every whole text as a signed 64-bit number; empty or null text: 0."""
    kind = docs.select(F.col(f"`{key}`")).schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            offsets = lists.offsets.to_numpy().astype(np.int64)
            hashes = lists.values.to_numpy(zero_copy_only=False).view(np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(majority(hashes, offsets).view(np.int64))], ["k", "fp"])

    ship(docs.sparkSession)
    df = docs.select(F.col(f"`{key}`").alias("k"), words(ascii_lower(F.col(f"`{text}`"))).alias("_w"))
    return (df.select("k", shingle_hashes(F.col("_w"), size).alias("h"))
            .mapInArrow(run, f"k {kind}, fp long").withColumnRenamed("k", key))


def _blocks(max_bits: int) -> list[tuple[int, int]]:
    """(first bit, length of the Hamming code) of each block."""
    n = max_bits // 2 + 1
    width = BITS // n
    code = 1
    while 2 * code + 1 <= width:
        code = 2 * code + 1
    return [(i * width, code) for i in range(n)]


def _syndrome(value: Column, code: int) -> Column:
    """Position (1..code) of the bit to flip to reach the home anchor; 0 at an anchor."""
    total = F.lit(0)
    for j in range(code.bit_length()):
        mask = sum(1 << (p - 1) for p in range(1, code + 1) if p >> j & 1)
        total = total + (F.bit_count(value.bitwiseAND(F.lit(mask))) % 2) * (1 << j)
    return total


def _flip(value: Column, position: Column) -> Column:
    return value.bitwiseXOR(F.when(position > 0, F.call_function("shiftleft", F.lit(1).cast("long"), position - 1))
                            .otherwise(F.lit(0).cast("long")))


def links(fps: DataFrame, max_bits: int) -> DataFrame:
    """Pairs (a < b) of different fingerprints (column fp, distinct) within ``max_bits`` bits."""
    if max_bits < 1:
        return fps.select(F.col("fp").alias("a"), F.col("fp").alias("b")).filter(F.lit(False))
    homes, copies = [], []
    for n, (start, code) in enumerate(_blocks(max_bits)):
        value = F.shiftrightunsigned("fp", start).bitwiseAND(F.lit((1 << code) - 1))
        part = fps.select("fp", value.alias("v")).withColumn("s", _syndrome(F.col("v"), code).cast("int"))
        home = _flip(F.col("v"), F.col("s"))
        homes.append(part.select(F.lit(n).alias("block"), home.alias("anchor"), F.col("fp").alias("a")))
        # from a value at distance 1 of its home, the other anchors at distance 2 flip
        # two positions whose xor is the syndrome; an anchor has no other that near
        pairs = F.transform(
            F.filter(F.sequence(F.lit(1), F.lit(code)), lambda i: (i < i.bitwiseXOR(F.col("s"))) & (F.col("s") > 0)),
            lambda i: _flip(_flip(F.col("v"), i), i.bitwiseXOR(F.col("s"))))
        copies.append(part.select(F.lit(n).alias("block"), F.explode(F.concat(F.array(home), pairs)).alias("anchor"),
                                  F.col("fp").alias("b")))
    left, right = homes[0], copies[0]
    for x, y in zip(homes[1:], copies[1:]):
        left, right = left.unionByName(x), right.unionByName(y)
    near = (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)
    return left.join(right, ["block", "anchor"]).filter(near).select("a", "b")


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable, for every node of an edge (a, b).

    Large-star links a node's larger neighbours to its smallest one, small-star its
    smaller ones and itself; in turn they reach stars. Each round is a written table;
    only its count and checksum come to the driver. Both steps are joins with one row
    per node on one side, so a hub's rows can be split.
    """
    def marked(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    def smallest(df: DataFrame) -> DataFrame:
        return df.groupBy("u").agg(F.min("v").alias("m"))

    edges = settle(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                   .filter("a <> b").distinct(), "edges")
    mark = marked(edges)
    while True:
        both = edges.selectExpr("a as u", "b as v").unionByName(edges.selectExpr("b as u", "a as v"))
        large = (both.filter("v > u").join(smallest(both), "u")
                 .select(F.col("v").alias("a"), F.least("u", "m").alias("b")))
        large = settle(large.filter("a <> b").distinct(), "edges")
        down = large.selectExpr("a as u", "b as v")  # every edge points to the smaller node
        small = down.join(smallest(down), "u")
        small = (small.selectExpr("v as a", "m as b").unionByName(small.selectExpr("u as a", "m as b"))
                 .filter("a <> b").distinct())
        edges = settle(small, "edges")
        now = marked(edges)
        if now == mark:
            break
        mark = now
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def rooted(marked: DataFrame, max_bits: int, key: str) -> DataFrame:
    """(fp, least, root): every distinct fingerprint of (key, fp), its smallest key and its component's smallest fingerprint."""
    least = settle(marked.groupBy("fp").agg(F.min(f"`{key}`").alias("least")), "distinct")
    nodes = components(links(least.select("fp"), max_bits))
    return least.join(nodes.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def near_duplicates(docs: DataFrame, size: int = 3, max_bits: int = 3, key: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """(key, fingerprint, component_id) of every document.

    ``component_id`` is the smallest key reachable over fingerprints that differ in
    ``max_bits`` bits at most. Null or empty texts share the fingerprint zero, which
    links like any other. Null keys stay null and never name a component (a component
    of null keys alone has a null id). Repeated rows give repeated rows; an empty
    table gives an empty result; other columns are not read.
    """
    marked = settle(fingerprints(docs, size, key, text), "fingerprints")
    grouped = settle(rooted(marked, max_bits, key), "grouped")
    ids = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    of = settle(grouped.join(ids, "root").select("fp", "component_id"), "members")
    out = marked.join(of, "fp")
    return out.select(key, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, size: int = 3, max_bits: int = 3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each component: that of the smallest key (of its repeated rows one).
    A component without any key keeps one of its rows.

    Rows are told apart by key and text, so null keys or a key of several texts are rows
    like any other: equal texts are always of one component, and a component's least
    (key, text digest), null keys last, is of no other one. A null text counts as empty; an
    empty table gives an empty result; all columns pass through, whatever their names."""
    name = F.col(f"`{key}`")
    digest = F.unhex(F.sha2(F.coalesce(F.col(f"`{text}`"), F.lit("")), 256))
    row = F.struct(name.isNull().alias("none"), name.alias("_head_key"), digest.alias("_head_digest"))
    marked = settle(fingerprints(docs.select(row.alias("row"), F.col(f"`{text}`").alias("text")), size, "row", "text"),
                    "fingerprints")
    heads = settle(rooted(marked, max_bits, "row").groupBy("root").agg(F.min("least").alias("least"))
                   .select("least._head_key", "least._head_digest"), "heads")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), name.alias("_key"), digest.alias("_digest"))
    same = F.col("_key").eqNullSafe(F.col("_head_key")) & (F.col("_digest") == F.col("_head_digest"))
    return rows.join(heads, same, "left_semi").dropDuplicates(["_key", "_digest"]).select("_row.*")
