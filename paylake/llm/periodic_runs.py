"""Detection of periodic runs with a dictionary of basic factors.

A run is a stretch of consecutive words with smallest period q, at least ``least`` words
and at least 2 q long, that no neighbouring word extends.

The dictionary names the factors of each power-of-two length L, equal factors of one text
alike: those of length 2 L are pairs of names of length L, and a factor that does not come
again in its text has no name, so in prose the dictionary soon runs empty. For each L,
periods from L up to 2 L are proposed by the successors of equal factors within 2 L:

* A factor whose own period is over L/2 has at most three more occurrences within 2 L;
  every one proposes its distance.
* Otherwise its occurrences form arithmetic progressions, one for each stretch of that
  period. Two progressions in a row, whose stretches touch, propose all distances from a
  member of the one to a member of the other, again an arithmetic progression.

One of the two finds every run of period q: its first word and the word q on begin equal
factors of length L. If one such pair of places in the run has a factor of the first kind,
that factor proposes q. If none has, all their factors share one period d <= L/2, so both
halves of the run lie in stretches of period d that touch, and q is a distance between
members of their progressions.

Proposals are extended to both sides by the dictionary, lengths of falling powers of two,
then those too short are left out, and the least period of each stretch stays. All steps
are array operations over the words of many texts at once; texts never meet, because
names differ between texts.
"""
from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylake.llm.bpe_trie import slices
from paylake.llm.common import crc_mod, ship, words

LEAST = 12                # words of the shortest run
SLICE_CHARS = 1_000_000   # characters whose words are searched at once
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _named(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order by key and place, group start flags, names): equal keys get one name from 0 on,
    a key that occurs once gets -1. Names are by place of ``keys``."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    first = np.ones(len(keys), bool)
    first[1:] = ranked[1:] != ranked[:-1]
    alone = first & np.append(first[1:], True)
    names = np.empty(len(keys), np.int64)
    names[order] = np.where(alone, -1, np.cumsum(first & ~alone) - 1)
    return order, first, names


class Dictionary:
    """Names of the factors of lengths 1, 2, 4, ... of several texts laid end to end.
    ``levels[k][i]`` names the factor of length 2**k at place i, -1 if it has no equal."""

    def __init__(self, word_ids: np.ndarray, text_of: np.ndarray):
        self.size = len(word_ids)
        self.levels: list[np.ndarray] = []
        self.equal: list[tuple[np.ndarray, np.ndarray]] = []  # places by name, and whether the next has the same
        at = np.arange(self.size)
        keys = text_of * (int(word_ids.max(initial=0)) + 1) + word_ids
        while len(at) > 1:
            order, first, names = _named(keys)
            level = np.full(self.size + 1, -1, np.int64)
            level[at] = names
            held = names[order] >= 0
            if not held.any():
                break
            self.levels.append(level)
            self.equal.append((at[order][held], ~np.append(first[1:], True)[held]))
            # factors twice as long: both halves have equals, and so lie in one text
            length = 1 << len(self.levels) - 1
            at = np.flatnonzero(level[:-1] >= 0)
            after = np.minimum(at + length, self.size)
            at, after = at[level[after] >= 0], after[level[after] >= 0]
            same = text_of[at] == text_of[np.minimum(after, self.size - 1)]
            at, after = at[same], after[same]
            keys = level[at] * (int(level.max()) + 1) + level[after]

    def after(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the longest common stretch that begins at a and at b (a < b)."""
        n = np.zeros(len(a), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            x = self.levels[k][np.minimum(a + n, self.size)]
            n += np.where((x >= 0) & (x == self.levels[k][np.minimum(b + n, self.size)]), 1 << k, 0)
        return n

    def before(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the longest common stretch that ends before a and before b (a < b)."""
        n = np.zeros(len(a), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            i, j = a - n - (1 << k), b - n - (1 << k)
            x = self.levels[k][np.maximum(i, 0)]
            n += np.where((i >= 0) & (x >= 0) & (x == self.levels[k][np.maximum(j, 0)]), 1 << k, 0)
        return n

    def proposals(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places i and periods q in 2**k .. 2**(k+1) - 1 such that equal factors begin at i and i + q."""
        length = 1 << k
        at, goes_on = self.equal[k]
        gap = np.where(goes_on, np.append(at[1:], 0) - at, 0)
        places, periods = [], []
        # the next three occurrences
        index, ahead = np.arange(len(at)), np.zeros(len(at), np.int64)
        far = index
        for _ in range(3):
            live = goes_on[far] & (ahead + gap[far] < 2 * length)
            index, ahead, far = index[live], ahead[live] + gap[far[live]], far[live] + 1
            wide = ahead >= length
            places.append(at[index[wide]])
            periods.append(ahead[wide])
        # progressions of a difference up to half the length, and the gaps between two of them
        close = goes_on & (2 * gap <= length)
        steps = np.arange(len(at))
        run_up = steps - np.maximum.accumulate(np.where(np.append(False, close[:-1]), -1, steps))
        run_on = np.minimum.accumulate(np.where(close, len(at), steps)[::-1])[::-1] - steps
        t = np.flatnonzero(goes_on & ~close & (gap < 2 * length))
        up, on = run_up[t], run_on[t + 1]
        step = np.where(up > 0, gap[t - 1], gap[np.minimum(t + 1, len(at) - 1)])
        use = (up + on > 0) & (gap[t] < length + 2 * step)
        t, up, on, step = t[use], up[use], on[use], step[use]
        count = np.minimum(up + on, (2 * length - 1 - gap[t]) // np.maximum(step, 1))
        which = np.repeat(np.arange(len(t)), count)
        r = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count) + 1
        t, up, step = t[which], up[which], step[which]
        q = gap[t] + r * step
        wide = q >= length
        places.append((at[t] - np.minimum(r, up) * step)[wide])
        periods.append(q[wide])
        return np.concatenate(places), np.concatenate(periods)

    def runs(self, least: int = LEAST) -> np.ndarray:
        """All runs as rows (start, length, period), by start and then period."""
        found = [np.empty((0, 3), np.int64)]
        for k in range(len(self.levels)):
            i, q = self.proposals(k)
            if not len(i):
                continue
            # neighbouring places with one period are of one stretch
            order = np.lexsort((i, q))
            i, q = i[order], q[order]
            new = np.append(True, (q[1:] != q[:-1]) | (i[1:] > i[:-1] + 1))
            i, q = i[new], q[new]
            start = i - self.before(i, i + q)
            length = i + self.after(i, i + q) + q - start
            long = length >= np.maximum(least, 2 * q)
            found.append(np.stack([start, length, q], 1)[long])
        every = np.concatenate(found)
        every = every[np.lexsort((every[:, 2], every[:, 1], every[:, 0]))]
        # one stretch, its least period
        new = np.ones(len(every), bool)
        new[1:] = (every[1:, :2] != every[:-1, :2]).any(1)
        every = every[new]
        return every[np.lexsort((every[:, 2], every[:, 0]))]


def search(texts: list[str], least: int = LEAST) -> list[tuple[int, np.ndarray, str]]:
    """(number of words, runs, words left when every period after the first is dropped) of each text."""
    split = [WORD.findall(t) for t in texts]
    sizes = np.array([len(w) for w in split], np.int64)
    ends = np.cumsum(sizes)
    number: dict[str, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for ws in split for w in ws), np.int64, int(sizes.sum()))
    runs = Dictionary(ids, np.repeat(np.arange(len(texts)), sizes)).runs(least)
    cover = np.zeros(len(ids) + 1, np.int64)
    np.add.at(cover, runs[:, 0] + runs[:, 2], 1)
    np.add.at(cover, runs[:, 0] + runs[:, 1], -1)
    cover = np.cumsum(cover) > 0
    bounds = np.searchsorted(runs[:, 0], ends - sizes), np.searchsorted(runs[:, 0], ends)
    out = []
    for ws, begin, end, lo, hi in zip(split, ends - sizes, ends, *bounds):
        mine = runs[lo:hi] - [begin, 0, 0]
        if len(mine):
            ws = [w for w, gone in zip(ws, cover[begin:end].tolist()) if not gone]
        out.append((int(end - begin), mine, " ".join(ws)))
    return out


def find_runs(docs: DataFrame, least: int = LEAST, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_words, runs array of (start, length, period), collapsed) of every whole text.

    Runs are ordered by start, then period; ``collapsed`` holds, joined by one space, the
    words that no run contains after its first period. Null text counts as empty: no words,
    no runs, an empty collapsed text. A null key stays null; repeated rows give repeated
    rows; runs of one start (ties) are told apart by period; an empty table gives an empty
    result; other columns of ``docs`` are not read, so their names cannot clash. Memory
    follows a slice of texts, a very long text being a slice of its own.
    """
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for texts in slices((t.as_py() or "" for t in batch.column(1)), SLICE_CHARS):
                got = search(texts, least)
                every = np.concatenate([g[1] for g in got])
                ends = np.concatenate([[0], np.cumsum([len(g[1]) for g in got])]).astype(np.int32)
                rows = pa.StructArray.from_arrays([pa.array(every[:, c]) for c in range(3)], FIELDS)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(texts)), pa.array([g[0] for g in got], pa.int64()),
                     pa.ListArray.from_arrays(pa.array(ends), rows), pa.array([g[2] for g in got], pa.string())],
                    ["k", "n_words", "runs", "collapsed"])
                at += len(texts)

    kind = docs.select(F.col(f"`{key}`")).schema[0].dataType.simpleString()
    df = docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t"))
    schema = f"k {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    return df.mapInArrow(run, schema).withColumnRenamed("k", key)


FIELDS = ["start", "length", "period"]


def with_planted(doc_id: Column, text: Column) -> Column:
    """The text, made periodic from some word on for one document in ten: with h the crc32 of
    the id, g = h / 10, n words, a = g mod n and p = 1 + (n - a) / (3 + g mod 8), word i >= a
    becomes word a + (i - a) mod p if h mod 10 = 0. A null id counts as the empty text (h = 0)."""
    h = F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    edit = lambda w: F.transform(F.array(F.struct(
        w.alias("w"), F.size(w).alias("n"), F.floor(h / 10).alias("g"))), _repeat)[0]
    return F.when(crc_mod(doc_id, 10) == 0, edit(words(text))).otherwise(text)


def _repeat(x: Column) -> Column:
    a = (x["g"] % F.greatest(x["n"], F.lit(1))).cast("int")
    p = 1 + F.floor((x["n"] - a) / (3 + x["g"] % 8)).cast("int")
    place = F.transform(F.sequence(F.lit(0), x["n"] - 1), lambda i: F.when(i < a, i).otherwise(a + (i - a) % p))
    return F.when(x["n"] > 0, F.array_join(F.transform(place, lambda i: F.get(x["w"], i)), " ")).otherwise("")


def digest(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """The report of :func:`find_runs`: number of runs, the longest (ties: least start, then
    period) with its exponent in thousandths, and digests of all runs and of the collapsed text."""
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    df = found.select(F.col(f"`{key}`").alias("k"), F.size("runs").cast("long").alias("n_runs"), best.alias("b"),
                      F.array_join(F.transform(line, lambda s: F.concat(s, F.lit("\n"))), "").alias("l"), "collapsed")
    return df.select(
        F.col("k").alias(key), "n_runs", (-F.col("b.s")).alias("start"), F.col("b.length").alias("length"),
        (-F.col("b.p")).alias("period"), F.expr("1000 * b.length div -b.p").alias("exponent_milli"),
        F.sha2("l", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
