"""Substring duplicates by relative Lempel-Ziv factors against an anchored index.

A text's 35-word windows are grouped into phrases: consecutive windows with the
same anchor, the 8-word gram of least hash inside the window (leftmost on ties).
Equal windows have equal anchors at equal places, so the corpus is its own
reference, indexed in blocks by anchor: a phrase can only match inside its block.

The parse is greedy: first whole phrases (the longest factors) are looked up in
their block; what is left over lies at factor boundaries and is checked there
window by window against one copy of every phrase of the block. All look-ups are
joins and counts by hash, so a passage that a third of all documents share is a
skewed join side with a unique other side, never a collected group.

Hashes: 64 bits for the anchor and 64 for the phrase or window, compared together.
"""
from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylake.llm.common import settle, ship, words

GRAM = 8
WORD = re.compile(r"[^\x20\x09-\x0D]+")
BASE = np.uint64(0x9E3779B97F4A7C15)
BROADCAST_ENTRIES = 1_000_000  # list entries (8 bytes each) and rows broadcast up to this count, shuffled beyond


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit words."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


class Rolling:
    """Hashes of any stretch of a word-hash array, by prefix sums modulo 2**64."""

    def __init__(self, h: np.ndarray):
        n = len(h)
        self.inverse = np.concatenate([[np.uint64(1)], np.full(n, np.uint64(pow(int(BASE), -1, 1 << 64)))]).cumprod(dtype=np.uint64)
        power = np.concatenate([[np.uint64(1)], np.full(n, BASE)]).cumprod(dtype=np.uint64)
        self.sums = np.concatenate([[np.uint64(0)], (mixed(h) * power[:-1]).cumsum(dtype=np.uint64)])

    def of(self, start: np.ndarray, size) -> np.ndarray:
        return mixed((self.sums[start + size] - self.sums[start]) * self.inverse[start])


def phrases(h: np.ndarray, offsets: np.ndarray, window: int) -> dict[str, np.ndarray]:
    """Phrases of the documents h[offsets[i]:offsets[i+1]]: document, first window,
    number of windows, anchor hash, phrase hash, and the rolling hash itself."""
    roll = Rolling(h)
    sizes = np.maximum(np.diff(offsets) - window + 1, 0)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    at = np.arange(sizes.sum()) - first[doc] + offsets[:-1][doc]  # every window's first word
    if not len(at):
        return {"roll": roll, "doc": doc, "start": at, "n": at, "a": at.astype(np.uint64), "r": at.astype(np.uint64)}
    spread = window - GRAM + 1
    low = roll.of(np.arange(len(h) - GRAM + 1), GRAM)
    where = np.arange(len(low))
    grams, width = low, 1
    while width < spread:  # least gram of every stretch, doubling its width
        step = min(width, spread - width)
        left, right = low[:-step], low[step:]
        take = left <= right
        low, where = np.where(take, left, right), np.where(take, where[:-step], where[step:])
        width += step
    anchor = where[at]
    new = np.ones(len(at), bool)
    new[1:] = (np.diff(anchor) != 0) | (np.diff(doc) != 0)
    begin = np.flatnonzero(new)
    n = np.diff(np.append(begin, len(at)))
    start, anchor = at[begin], anchor[begin]
    r = roll.of(start, n + window - 1) ^ mixed((n * 64 + anchor - start).astype(np.uint64))
    return {"roll": roll, "doc": doc[begin], "start": start, "n": n, "a": grams[anchor], "r": r}


def _hashed(text: Column) -> Column:
    return F.transform(words(text), lambda w: F.xxhash64(w))


def _lists(batch: pa.RecordBatch, column: int) -> tuple[np.ndarray, np.ndarray]:
    lists = batch.column(column)
    return lists.values.to_numpy(zero_copy_only=False).view(np.uint64), lists.offsets.to_numpy().astype(np.int64)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _bounded(df: DataFrame, name: str, lists: str) -> DataFrame:
    """``df`` written, with a broadcast hint only if its counted size is within bounds."""
    df = settle(df, name)
    size = df.agg(F.count(F.lit(1)) + F.coalesce(F.sum(F.size(lists)), F.lit(0))).first()[0]
    return F.broadcast(df) if size <= BROADCAST_ENTRIES else df


def _with_lists(body: DataFrame, lists: DataFrame, how: str) -> DataFrame:
    right = lists.withColumnRenamed("k", "_rk").withColumnRenamed("x", "_rx")
    return body.join(right, body.k.eqNullSafe(right._rk) & (body.x == right._rx), how).drop("_rk", "_rx")


def duplicate_spans(body: DataFrame, window: int) -> DataFrame:
    """(k, x, spans): for each row key (k, x) of ``body`` (k, x, t) the runs of
    windows, struct(start, n) in words, that also start elsewhere."""
    kind = body.schema["k"].dataType.simpleString()
    ship(body.sparkSession)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, offsets = _lists(batch, 2)
            p = phrases(h, offsets, window)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(p["doc"])), batch.column(1).take(pa.array(p["doc"])),
                 pa.array((p["start"] - offsets[p["doc"]]).astype(np.int32)), pa.array(p["n"].astype(np.int32)),
                 _signed(p["a"]), _signed(p["r"])], ["k", "x", "start", "n", "a", "r"])

    def inspect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, offsets = _lists(batch, 2)
            p = phrases(h, offsets, window)
            wanted, ends = _lists(batch, 3)
            # the phrases asked for, by (document, start * 2 + whether it is open)
            owner = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
            place = wanted[ends[0]:ends[-1]].view(np.int64)
            asked = (owner << 40) + (place >> 1)
            order = np.argsort(asked)
            mine = (p["doc"].astype(np.int64) << 40) + p["start"] - offsets[p["doc"]]
            spot = np.searchsorted(asked[order], mine)
            hit = np.zeros(len(mine), bool)
            inside = spot < len(asked)
            hit[inside] = asked[order][spot[inside]] == mine[inside]
            pick = np.flatnonzero(hit)
            open_ = (place[order][spot[pick]] & 1).astype(bool)
            n = p["n"][pick]
            each = np.repeat(pick, n)
            at = p["start"][each] + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            doc = p["doc"][each]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(doc)), batch.column(1).take(pa.array(doc)),
                 pa.array((at - offsets[doc]).astype(np.int32)), pa.array(np.repeat(open_, n)),
                 _signed(p["a"][each]), _signed(p["roll"].of(at, window))], ["k", "x", "start", "open", "a", "w"])

    found = settle(body.select("k", "x", _hashed(F.col("t")).alias("h")).mapInArrow(
        parse, f"k {kind}, x long, start int, n int, a long, r long"), "phrases")
    shared = found.groupBy("a").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("a")
    found = settle(found.join(shared, "a"), "shared")
    kinds = found.groupBy("a", "r").agg(F.count(F.lit(1)).alias("c"), F.min(F.struct("k", "x", "start")).alias("one"))
    kinds = settle(kinds, "kinds")
    mixed_blocks = kinds.groupBy("a").agg(F.count(F.lit(1)).alias("m"), F.min("c").alias("least")).filter("m > 1 and least = 1")
    # whole phrases met more than once
    whole = found.join(kinds.filter("c > 1").select("a", "r"), ["a", "r"]).select("k", "x", "start", "n")
    # phrases met once, in a block with others: their windows against one copy of each
    asked = kinds.join(mixed_blocks.select("a"), "a").select(
        "one.k", "one.x", (F.col("one.start").cast("long") * 2 + (F.col("c") == 1).cast("long")).alias("p"))
    asked = _bounded(asked.groupBy("k", "x").agg(F.collect_list("p").alias("p")), "asked", "p")
    rows = _with_lists(body, asked, "inner").select("k", "x", _hashed(F.col("t")).alias("h"), "p")
    rows = rows.dropDuplicates(["k", "x"])  # repeated rows stand for one copy here: their phrases met twice
    windows = settle(rows.mapInArrow(inspect, f"k {kind}, x long, start int, open boolean, a long, w long"), "windows")
    again = windows.groupBy("a", "w").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("a", "w")
    partly = windows.filter("open").join(again, ["a", "w"]).select("k", "x", "start", F.lit(1).alias("n"))
    return whole.distinct().unionByName(partly).groupBy("k", "x").agg(
        F.collect_list(F.struct("start", "n")).alias("spans"))


def covered(n: int, spans: list[tuple[int, int]], window: int) -> np.ndarray:
    """Mask of the words inside a window that starts in one of the runs (start, number)."""
    change = np.zeros(n + 1, np.int64)
    for start, count in spans:
        change[start] += 1
        change[min(n, start + count + window - 1)] -= 1
    return np.cumsum(change[:-1]) > 0


def _body(docs: DataFrame, key: str, text: str) -> DataFrame:
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    return docs.select(F.col(f"`{key}`").alias("k"), F.xxhash64(t).alias("x"), t.alias("t"))


def remove_repeats(docs: DataFrame, window: int = 35, key: str = "doc_id", text: str = "text",
                   texts: bool = False) -> DataFrame:
    """(key, n_words, n_removed, kept_sha256) of every row, and ``kept_text`` with ``texts``.

    Each word covered by a ``window``-word window whose words also start anywhere
    else (another row or another place of the text) is removed; all copies go. Null
    text counts as empty; texts shorter than a window stay whole; a row is known by
    its key (null allowed) and text, and repeated rows repeat each other's windows;
    an empty table gives an empty result; other columns are not read.
    """
    body = _body(docs, key, text)
    spans = _bounded(duplicate_spans(body, window), "spans", "spans")
    kind = body.schema["k"].dataType.simpleString()
    names = ["k", "n_words", "n_removed", "kept_sha256"] + ["kept_text"] * texts

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for t, s, n in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3))):
                ws = WORD.findall(t)
                gone = 0
                kept = ws
                if s:
                    mask = covered(len(ws), list(zip(s, n)), window)
                    gone = int(mask.sum())
                    kept = [w for w, m in zip(ws, mask.tolist()) if not m]
                line = " ".join(kept)
                rows.append((len(ws), gone, hashlib.sha256(line.encode()).hexdigest(), line))
            cols = list(zip(*rows)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()),
                 *[pa.array(c, pa.string()) for c in cols[2:3 + texts]]], names)

    df = _with_lists(body, spans, "left").select("k", "t", "spans.start", "spans.n")
    out = df.mapInArrow(cut, f"k {kind}, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * texts)
    return out.withColumnRenamed("k", key)
