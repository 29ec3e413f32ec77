"""Language-model scores by context-tree weighting over bytes.

A byte is eight binary decisions; each of the 255 decision nodes has its own tree
over the preceding bytes. Every tree node holds a Krichevsky-Trofimov estimate of
its decisions; the weighted probability of a node is half its own estimate and half
the product of its children's, which mixes the estimates of all depths.

Counts are order-free, so training is one distributed count of (context, byte)
grams over all training texts, rolled up depth by depth. Every context has its node.
The trunk, contexts that hold at least 1 / ``share`` of all positions (``share`` at most
at each depth), is broadcast. Where a path leaves the trunk a branch begins: all contexts
below one that holds less than that share. Branches are dealt to blocks by their root, and
a block is weighed by one task; the roots' weights enter the trunk as a sum by trunk node.
To score, a slice of texts asks each block once for its distinct grams there, and the
answers meet the slice again. A slice, a block and the trunk are bounded, so memory is.

The base score (smoothed word counts) covers the whole vocabulary: words of at
least 1 / ``heavy`` of all tokens (``heavy`` at most) go along as a table, all
others are joined by word, each with less than that share of the rows.
"""
from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylake.llm.bpe_trie import slices
from paylake.llm.common import ascii_lower, crc_mod, settle, ship, words

SCORED_CHARS = 4_000_000  # characters scored at once: some 60 bytes of working memory each
HELD_GRAMS = 2_000_000  # distinct grams a task holds before it sends them on
BLOCK_GRAMS = 400_000  # distinct grams of a block of branches, about
BLOCK_PLACES = 12_000_000  # places of all texts for each block, about
FINE = 2.0 ** 24  # branch weights are added as whole parts of 1 / FINE, so in any order
EDGE = 0xFF  # not a UTF-8 byte: stands before and after every text


@dataclass
class Model:
    depth: int
    code: np.ndarray    # byte before -> column of child
    child: np.ndarray   # state x column -> state
    score: np.ndarray   # state x next byte -> log10 probability


@dataclass
class Trunk:
    depth: int
    blocks: int
    code: np.ndarray    # byte before -> column of child
    child: np.ndarray   # state x column -> state
    leaf: int           # first state of full depth
    exit: int           # first state behind the trunk: one for each trunk node below full depth
    below: np.ndarray   # depth of the branches' roots by such state


@dataclass
class Weights:
    score: np.ndarray   # full context x next byte -> log10 probability
    column: np.ndarray  # decision node -> column of lead and open
    lead: np.ndarray    # exit x column -> the trunk's part of the probability of a one
    open: np.ndarray    # exit x column -> weight of the branch's probability


@dataclass
class Base:
    heavy: dict[bytes, int]
    total: int
    distinct: int


def padded(texts: list[str], depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The lower-cased texts' bytes, each behind ``depth`` edge bytes and one at the end of
    all; the scored places (every byte and the edge after it) and their number by text."""
    raw = [t.encode("utf-8", "surrogatepass").lower() for t in texts]
    edge = bytes([EDGE]) * depth
    data = np.frombuffer(edge.join([b"", *raw, b""]), np.uint8)
    sizes = np.array([len(r) + 1 for r in raw], np.int64)
    starts = np.cumsum(sizes - 1 + depth) - (sizes - 1)
    first = np.cumsum(sizes) - sizes
    return data, np.repeat(starts - first, sizes) + np.arange(sizes.sum()), sizes


def packed(data: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """``depth`` context bytes and the next byte at every place, the next byte lowest."""
    g = np.zeros(len(at), np.uint64)
    for back in range(depth, -1, -1):
        g = (g << np.uint64(8)) | data[at - back]
    return g


def planes(values: np.ndarray) -> bytes:
    """Whole numbers as eight planes of bytes (of sorted or small ones most are long runs), compressed,
    behind how many they are."""
    raw = values.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()
    return len(values).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def unpacked(raw: bytes) -> np.ndarray:
    size = 8 * int.from_bytes(raw[:8], "little")
    flat = np.frombuffer(pa.decompress(raw[8:], size, "zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(flat.reshape(8, -1).T).view("<u8").ravel()


def from_planes(raws: list[bytes]) -> np.ndarray:
    """The numbers of all the given planes, one after the other."""
    return np.concatenate([np.zeros(0, np.uint64), *map(unpacked, raws)])


def groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the runs of equal sorted keys, and the run of every key."""
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    return np.flatnonzero(new), np.cumsum(new) - 1


def added(g: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct grams, sorted, and the sums of their counts."""
    order = np.argsort(g)
    g = g[order]
    start, _ = groups(g)
    return g[start], np.add.reduceat(n[order], start) if len(g) else n


def spread(keys: np.ndarray, blocks: int) -> np.ndarray:
    """A block of every key."""
    mixed = keys * np.uint64(0x9E3779B97F4A7C15)
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((mixed >> np.uint64(33)) % np.uint64(blocks)).astype(np.int32)


def by_block(block: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(block, the places where it stands), by block."""
    order = np.argsort(block, kind="stable")
    start, _ = groups(block[order])
    for part in np.split(order, start[1:]) if len(order) else []:
        yield int(block[part[0]]), part


def packed_rows(block: np.ndarray, g: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    """(block, g, n): one row for each block."""
    got = [(b, planes(g[part]), planes(n[part])) for b, part in by_block(block)]
    return pa.RecordBatch.from_arrays([pa.array([x[i] for x in got], s) for i, s in
                                       enumerate((pa.int32(), pa.binary(), pa.binary()))], ["block", "g", "n"])


def grams(docs: DataFrame, depth: int, least: int, blocks: int) -> DataFrame:
    """(d, g, n): counts of ``depth`` context bytes and the next byte, packed into a long (d = -1); those
    whose context occurs ``least`` times, at ``depth`` and one less (d); parts of the counts at two less
    (-2). Grams meet in blocks by all context bytes but the farthest."""
    ship(docs.sparkSession)
    near = np.uint64((1 << 8 * (depth - 1)) - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for texts in slices(batch.column(0).to_pylist()):
                data, at, _ = padded(texts, depth)
                g = packed(data, at, depth)
                g.sort()
                start, _ = groups(g)
                held.append((g[start], np.diff(np.append(start, len(g)))))
                size += len(start)
                if size > HELD_GRAMS:
                    held = [added(*map(np.concatenate, zip(*held)))]
                    size = len(held[0][0])
                    if size > HELD_GRAMS // 2:
                        yield packed_rows(spread((held[0][0] >> np.uint64(8)) & near, blocks), *held[0])
                        held, size = [], 0
        if held:
            g, n = added(*map(np.concatenate, zip(*held)))
            yield packed_rows(spread((g >> np.uint64(8)) & near, blocks), g, n)

    def merge(block: pa.Table) -> pa.Table:
        g, n = added(*(from_planes(block.column(c).to_pylist()).astype(np.int64) for c in "gn"))
        parts = [(-1, g, n)]
        for d in (depth, depth - 1):
            g, n = (g, n) if d == depth else added(g & ((1 << 8 * (d + 1)) - 1), n)
            start, context = groups(g >> 8)
            heavy = (np.add.reduceat(n, start) >= least)[context]
            parts.append((d, g[heavy], n[heavy]))
        if depth > 1:
            parts.append((-2, *added(g & ((1 << 8 * (depth - 1)) - 1), n)))
        return pa.table({"d": np.concatenate([np.full(len(x[1]), x[0], np.int32) for x in parts]),
                         "g": np.concatenate([x[1] for x in parts]), "n": np.concatenate([x[2] for x in parts])})

    rows = docs.select("t").mapInArrow(run, "block int, g binary, n binary")
    return rows.groupBy("block").applyInArrow(merge, "d int, g long, n long")


def log_gamma(x: np.ndarray) -> np.ndarray:
    """log of the gamma function for x > 0 (Stirling's series after a shift by 8)."""
    shift = np.zeros_like(x)
    for i in range(8):
        shift += np.log(x + i)
    y = x + 8
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y ** 3) - shift


def estimate(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """log of the Krichevsky-Trofimov probability of the counts."""
    out = np.zeros(len(zeros))
    some = np.flatnonzero(zeros + ones)
    a, b = zeros[some], ones[some]
    out[some] = log_gamma(a + 0.5) + log_gamma(b + 0.5) - log_gamma(a + b + 1) - math.log(math.pi)
    return out


HALVES, WHOLES = (log_gamma(np.arange(4096) + x) for x in (0.5, 1.0))


def small_estimate(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """``estimate`` with a table for the small counts that most branches have."""
    both = zeros + ones
    i, j, k = (np.minimum(x, 4095).astype(np.int64) for x in (zeros, ones, both))
    out = HALVES[i] + HALVES[j] - WHOLES[k] - math.log(math.pi)
    out[both == 0] = 0.0
    large = np.flatnonzero(both > 4095)
    out[large] = estimate(zeros[large], ones[large])
    return out


class Level:
    """The kept contexts of one depth, with their (context, next byte, count) rows by byte."""

    def __init__(self, contexts: np.ndarray, following: np.ndarray, counts: np.ndarray):
        self.keys = np.unique(contexts)
        order = np.argsort(following, kind="stable")
        self.node = np.searchsorted(self.keys, contexts[order])
        self.byte, self.count = following[order], counts[order].astype(np.float64)

    def sums(self, low: int, high: int) -> np.ndarray:
        """Count of next bytes in low..high-1 by context."""
        a, b = np.searchsorted(self.byte, [low, high])
        return np.bincount(self.node[a:b], self.count[a:b], len(self.keys)).astype(np.float64)


def states(levels: list[Level], depth: int | None = None):
    """(up, inner, first, rests, code, child) of the kept contexts of every depth (packed, nearest
    byte lowest). Inner are those with kept children, with ``depth`` all above that depth."""
    sizes = [len(x.keys) for x in levels]
    up = [np.searchsorted(levels[d - 1].keys, levels[d].keys & ((1 << 8 * (d - 1)) - 1)) if d else None
          for d in range(len(levels))]
    inner = [np.full(n, depth is not None and d < depth) for d, n in enumerate(sizes)]
    for d in range(1, len(levels)):
        inner[d - 1][up[d]] = True
    # states: the contexts by depth, then the rest child of each that has children
    first = np.cumsum([0, *sizes])
    rests = first[-1] + np.cumsum([0, *[int(x.sum()) for x in inner]])
    total = int(rests[-1])
    seen = np.unique(np.concatenate([(x.keys >> (8 * i)) & 255 for d, x in enumerate(levels) for i in range(d)] or [[]]))
    code = np.full(256, len(seen), np.int64)
    code[seen.astype(int)] = np.arange(len(seen))
    child = np.repeat(np.arange(total, dtype=np.int32)[:, None], len(seen) + 1, 1)
    for d in range(len(levels)):
        child[first[d] + np.flatnonzero(inner[d])] = np.arange(rests[d], rests[d + 1])[:, None]
        if d:
            child[first[d - 1] + up[d], code[levels[d].keys >> (8 * (d - 1))]] = first[d] + np.arange(sizes[d])
    return up, inner, first, rests, code, child


def weigh(levels: list[Level], depth: int) -> Model:
    """The model of the kept contexts alone; what they leave over is one child more of each."""
    up, inner, first, rests, code, child = states(levels)
    total = len(child)
    ones: dict[int, np.ndarray] = {}
    for v in range(1, 256):  # the decision nodes of a byte: 1 is the first, v leads to 2v and 2v + 1
        width = 256 >> (v.bit_length() - 1)
        low = v * width - 256
        if levels[0].sums(low, low + width).sum():
            ones[v] = decide(levels, up, inner, first, rests, low, width)[0]
    return Model(depth, code, child, byte_scores(ones, total))


def byte_scores(ones: dict[int, np.ndarray], total: int) -> np.ndarray:
    """log10 probability of every next byte from the probability of a one at its decision nodes."""
    score = np.empty((total, 256), np.float32)
    for at in range(0, total, 4096):
        logs = np.zeros((min(4096, total - at), 512))
        for v in range(1, 256):
            one = ones[v][at:at + 4096] if v in ones else np.float32(0.5)
            logs[:, 2 * v] = logs[:, v] + np.log10(1.0 - one)
            logs[:, 2 * v + 1] = logs[:, v] + np.log10(one)
        score[at:at + 4096] = logs[:, 256:]
    return score


def weigh_trunk(levels: list[Level], depth: int, sums: tuple[np.ndarray, np.ndarray, np.ndarray]) -> Weights:
    """The trunk's weights, given (exit, decision node, weight of the branches there), by decision node."""
    up, inner, first, rests, _, child = states(levels, depth)
    exits, nodes, weights = sums
    column, lead, open_, ones = np.zeros(256, np.int64), [np.zeros(len(child) - rests[0])], [np.ones(len(child) - rests[0])], {}
    leaf = int(first[depth]) if len(levels) > depth else int(rests[0])
    for v in range(1, 256):
        width = 256 >> (v.bit_length() - 1)
        low = v * width - 256
        if levels[0].sums(low, low + width).sum():
            a, b = np.searchsorted(nodes, [v, v + 1])
            branches = np.bincount(exits[a:b], weights[a:b], len(child) - rests[0])
            one, rest = decide(levels, up, inner, first, rests, low, width,
                               [branches[rests[d] - rests[0]:rests[d + 1] - rests[0]] for d in range(len(levels))])
            column[v] = len(lead)
            ones[v] = one[leaf:rests[0]]
            lead.append(one[rests[0]:])
            open_.append(rest)
    return Weights(byte_scores(ones, int(rests[0]) - leaf), column, np.stack(lead, 1).astype(np.float32),
                   np.stack(open_, 1).astype(np.float32))


def decide(levels, up, inner, first, rests, low: int, width: int, branches=None) -> tuple[np.ndarray, np.ndarray]:
    """Probability of a one at the decision node over bytes low..low+width-1, by state, and what is
    open behind inner states. With ``branches`` (weights by inner state of each depth) those children
    are weighed elsewhere, and an inner state's rest has its part without what is open."""
    half = low + width // 2
    zeros = [x.sums(low, half) for x in levels]
    ones = [x.sums(half, low + width) for x in levels]
    left = [(z.copy(), o.copy()) for z, o in zip(zeros, ones)]  # what the children leave over
    for d in range(1, len(levels)):
        left[d - 1][0][:] -= np.bincount(up[d], zeros[d], len(zeros[d - 1]))
        left[d - 1][1][:] -= np.bincount(up[d], ones[d], len(ones[d - 1]))
    own, weighted = [None] * len(levels), None
    for d in range(len(levels) - 1, -1, -1):
        alone = estimate(zeros[d], ones[d])
        product = estimate(*left[d]) if branches is None else np.zeros(len(alone))
        if branches is not None:
            product[inner[d]] = branches[d]
        if d + 1 < len(levels):
            product += np.bincount(up[d + 1], weighted, len(alone))
        both = math.log(0.5) + np.logaddexp(alone, product)
        weighted = np.where(inner[d], both, alone)
        own[d] = np.where(inner[d], np.exp(math.log(0.5) + alone - both), 1.0)  # weight of the own estimate
    out = np.full(int(rests[-1]), 0.5, np.float32)
    behind = np.ones(int(rests[-1] - rests[0]))
    so_far, open_ = np.zeros(1), np.ones(1)
    for d in range(len(levels)):
        if d:
            so_far, open_ = so_far[up[d]], open_[up[d]]
        so_far = so_far + open_ * own[d] * (ones[d] + 0.5) / (zeros[d] + ones[d] + 1)
        open_ = open_ * (1 - own[d])
        leaf = np.flatnonzero(~inner[d])
        out[first[d] + leaf] = so_far[leaf]
        z, o = (x[inner[d]] for x in left[d])
        behind[rests[d] - rests[0]:rests[d + 1] - rests[0]] = open_[inner[d]]
        rest = open_[inner[d]] * (o + 0.5) / (z + o + 1) if branches is None else 0.0
        out[rests[d]:rests[d + 1]] = so_far[inner[d]] + rest
    return np.clip(out, 1e-30 if branches is None else 0, np.float32(1) - np.float32(6e-8)), behind


def heavy_levels(docs: DataFrame, depth: int, share: int) -> tuple[list[Level], DataFrame, int]:
    """Count the texts (column t): the contexts of every depth that hold 1 / ``share`` of all places, with
    their counts; all grams (g, n); the number of places."""
    total = docs.agg(F.sum(F.octet_length("t") + 1)).first()[0] or 0
    least = max(1, math.ceil(total / share))
    table = settle(grams(docs, depth, least, max(1, math.ceil(total / BLOCK_PLACES))), "grams", "zstd")
    levels: list[Level] = []
    for d in (depth, depth - 1):
        got = table.filter(F.col("d") == d).select("g", "n").toArrow()
        g, n = (got.column(i).to_numpy() for i in range(2))
        levels.insert(0, Level(g >> 8, g & 255, n))
    rest = table.filter("d = -2").select("g", "n")
    for d in range(depth - 2, -1, -1):
        rest = settle(rest.groupBy(F.col("g").bitwiseAND(F.lit((1 << 8 * (d + 1)) - 1)).alias("g"))
                      .agg(F.sum("n").alias("n")), "grams")
        row = rest.select(F.shiftright("g", 8).alias("c"), F.col("g").bitwiseAND(F.lit(255)).alias("b"), "n")
        kept = row.groupBy("c").agg(F.sum("n").alias("s")).filter(F.col("s") >= least).select("c")
        got = row.join(kept, "c").toArrow()
        levels.insert(0, Level(*(got.column(i).to_numpy() for i in range(3))))
    return ([x for x in levels if len(x.keys)] or [Level(*np.zeros((3, 1), np.int64))],
            table.filter("d = -1").select("g", "n"), total)


def train_tree(docs: DataFrame, depth: int = 6, share: int = 1 << 16) -> Model:
    """The tree of the heavy contexts alone, on the driver, for comparison: ``score`` uses the
    whole tree (``train_trunk`` and its branches). Texts are column t; ``depth`` is 6 at most."""
    return weigh(heavy_levels(docs, depth, share)[0], depth)


def walk(trunk: Trunk, g: np.ndarray) -> np.ndarray:
    """The trunk's state of every packed gram: of full depth, or where it leaves the trunk."""
    columns, child, state = trunk.child.shape[1], trunk.child.ravel(), np.zeros(len(g), np.int64)
    for back in range(1, trunk.depth + 1):
        byte = (g >> np.uint64(8 * back)) & np.uint64(255)
        state = child[state * columns + trunk.code[byte.astype(np.int64)]].astype(np.int64)
    return state


def block_of(trunk: Trunk, g: np.ndarray, state: np.ndarray) -> np.ndarray:
    """The block of grams that leave the trunk: by the context that is their branch's root."""
    root = trunk.below[state - trunk.exit].astype(np.uint64)
    context = (g >> np.uint64(8)) & ((np.uint64(1) << (root * np.uint64(8))) - np.uint64(1))
    return spread((context << np.uint64(3)) | root, trunk.blocks)


def branch_grams(table: DataFrame, sent) -> DataFrame:
    """(block, g, n): the counted grams that leave the trunk, many in a row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            g = batch.column(0).to_numpy().astype(np.uint64)
            state = walk(sent.value, g)
            out = np.flatnonzero(state >= sent.value.exit)
            held.append((block_of(sent.value, g[out], state[out]), g[out], batch.column(1).to_numpy()[out]))
            size += len(out)
            if size > HELD_GRAMS // 4:
                yield packed_rows(*map(np.concatenate, zip(*held)))
                held, size = [], 0
        if size:
            yield packed_rows(*map(np.concatenate, zip(*held)))

    return table.select("g", "n").mapInArrow(run, "block int, g binary, n binary")


def weigh_branches(trunk: Trunk, g: np.ndarray, n: np.ndarray) -> Iterator[tuple]:
    """Weigh whole branches, given their distinct grams (count 0: asked for, not seen). For each of the
    eight decisions: the weights of the roots as (exit, decision node, weight), then the decision
    node, bit and probability of a one below the root, by gram."""
    depth = trunk.depth
    state = walk(trunk, g) - trunk.exit
    root = trunk.below[state].astype(np.int64)
    byte = (g & np.uint64(255)).astype(np.int64)
    near = (g >> np.uint64(8)).byteswap() >> np.uint64(64 - 8 * depth)  # nearest byte highest
    for k in range(8):
        v, bit = (1 << k) | (byte >> (8 - k)), (byte >> (7 - k)) & 1
        key = (v.astype(np.uint64) << np.uint64(8 * depth)) | near
        order = np.argsort(key)
        key = key[order]
        start, node = groups(key)
        key, at, top = key[start], state[order][start], root[order][start]
        zeros = np.add.reduceat(np.where(bit, 0, n)[order], start)
        ones = np.add.reduceat(np.where(bit, n, 0)[order], start)
        weight = small_estimate(zeros, ones)
        steps, roots = [(np.ones(len(zeros)), (ones + 0.5) / (zeros + ones + 1), top == depth, None)], []
        for d in range(depth - 1, -1, -1):
            over = top == d + 1
            roots.append((at[over], key[over] >> np.uint64(8 * (d + 1)), weight[over]))
            on = np.flatnonzero(~over)
            if not len(on):
                break
            key, at, top = key[on] >> np.uint64(8), at[on], top[on]
            start, up = groups(key)
            key, at, top = key[start], at[start], top[start]
            zeros, ones = np.add.reduceat(zeros[on], start), np.add.reduceat(ones[on], start)
            alone = small_estimate(zeros, ones)
            weight = math.log(0.5) + np.logaddexp(alone, np.add.reduceat(weight[on], start))
            steps.append((np.exp(math.log(0.5) + alone - weight), (ones + 0.5) / (zeros + ones + 1), top == d, (on, up)))
        so_far, open_ = np.zeros(0), np.zeros(0)
        for i in range(len(steps) - 1, -1, -1):
            own, p, _, _ = steps[i]
            before, rest = np.zeros(len(own)), np.ones(len(own))
            if i + 1 < len(steps):
                on, up = steps[i + 1][3]
                before[on], rest[on] = so_far[up], open_[up]
            so_far, open_ = before + rest * own * p, rest * (1 - own)
        one = np.empty(len(g))
        one[order] = so_far[node]
        yield tuple(np.concatenate(x) for x in zip(*roots)), v, bit, one


def train_trunk(docs: DataFrame, depth: int = 6, share: int = 1 << 16) -> tuple:
    """Count the texts (column t) and weigh the whole tree: (broadcast trunk, its weights, the branches'
    grams). ``depth`` is 6 at most. At most ``share`` contexts of each depth reach the driver, with
    256 counts and 256 weights each."""
    sc = ship(docs.sparkSession)
    levels, table, total = heavy_levels(docs, depth, share)
    _, inner, first, rests, code, child = states(levels, depth)
    blocks = max(1, math.ceil(table.count() / BLOCK_GRAMS), math.ceil(total / BLOCK_PLACES))
    trunk = Trunk(depth, blocks, code, child, int(first[depth]) if len(levels) > depth else int(rests[0]), int(rests[0]),
                  np.concatenate([np.full(int(x.sum()), d + 1, np.int8) for d, x in enumerate(inner)]))
    sent = sc.broadcast(trunk)
    branches = branch_grams(table, sent)

    def run(block: pa.Table) -> pa.Table:
        rows, (g, n) = [], (from_planes(block.column(c).to_pylist()) for c in "gn")
        for (at, v, weight), *_ in weigh_branches(sent.value, g, n.astype(np.float64)):
            node, pos = np.unique((v.astype(np.int64) << 32) | at, return_inverse=True)
            rows.append((node, np.bincount(pos, np.rint(weight * FINE))))
        node, weight = (np.concatenate(x) for x in zip(*rows))
        return pa.table({"node": node, "w": weight.astype(np.int64)})

    sums = (branches.groupBy("block").applyInArrow(run, "node long, w long").groupBy("node").agg(F.sum("w").alias("w"))
            .toArrow())
    node, weight = (sums.column(i).to_numpy() for i in range(2))
    order = np.argsort(node)
    node, weight = node[order], weight[order] / FINE
    return sent, weigh_trunk(levels, depth, (node & 0xFFFFFFFF, node >> 32, weight)), branches


def asked(trunk: Trunk, texts: list[str]) -> Iterator[tuple[int, bytes]]:
    """(block, grams): the texts' distinct grams that leave the trunk."""
    data, at, _ = padded(texts, trunk.depth)
    g = np.unique(packed(data, at, trunk.depth))
    state = walk(trunk, g)
    out = state >= trunk.exit
    g = g[out]
    for b, part in by_block(block_of(trunk, g, state[out])):
        yield b, planes(g[part])


def gram_logs(trunk: Trunk, weights: Weights, g: np.ndarray, n: np.ndarray) -> np.ndarray:
    """log10 probability of distinct grams outside the trunk, given all counted ones of their branches."""
    exits, out = walk(trunk, g) - trunk.exit, np.zeros(len(g))
    for _, v, bit, one in weigh_branches(trunk, g, n):
        column = weights.column[v]
        p = np.clip(weights.lead[exits, column] + weights.open[exits, column] * one, 1e-30, 1 - 6e-8)
        out += np.log10(np.where(bit, p, 1 - p))
    return out


def whole_scores(trunk: Trunk, score: np.ndarray, texts: list[str], answers: dict[int, bytes]) -> tuple[np.ndarray, np.ndarray]:
    """log10 probability of every text with its end, and its number of bytes, given the blocks' answers."""
    data, at, sizes = padded(texts, trunk.depth)
    places = packed(data, at, trunk.depth)
    g = np.unique(places)
    state = walk(trunk, g)
    logs, out = np.empty(len(g)), np.flatnonzero(state >= trunk.exit)
    full = np.flatnonzero(state < trunk.exit)
    logs[full] = score[state[full] - trunk.leaf, (g[full] & np.uint64(255)).astype(np.int64)]
    block = block_of(trunk, g[out], state[out])
    if len(out):
        logs[out[np.argsort(block, kind="stable")]] = np.frombuffer(b"".join(answers[b] for b in sorted(answers)), np.float32)
    return np.add.reduceat(logs[np.searchsorted(g, places)], np.cumsum(sizes) - sizes), sizes - 1


def tree_scores(model: Model, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """log10 probability of every text with its end, and its number of bytes."""
    data, at, sizes = padded(texts, model.depth)
    columns, child, state = model.child.shape[1], model.child.ravel(), np.zeros(len(at), np.int64)
    before = model.code[data]
    for back in range(1, model.depth + 1):
        state = child[state * columns + before[at - back]].astype(np.int64)
    logs = model.score.ravel()[(state << 8) + data[at]].astype(np.float64)
    return np.add.reduceat(logs, np.cumsum(sizes) - sizes), sizes - 1


def train_base(docs: DataFrame, heavy: int) -> tuple[Base, DataFrame]:
    """Word counts of the texts (column t): the base's totals and heavy words, and all counts (w, c)."""
    counts = settle(docs.select(F.explode(words(ascii_lower(F.col("t")))).alias("w")).groupBy("w")
                    .agg(F.count(F.lit(1)).alias("c")), "vocabulary")
    row = counts.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).first()
    ends = docs.count()
    total, distinct = (row.n or 0) + ends, row.v + (ends > 0)
    least = max(1, math.ceil(total / heavy))
    top = counts.filter(F.col("c") >= least).toArrow()
    table = {w.encode(): c for w, c in zip(top.column("w").to_pylist(), top.column("c").to_pylist())}
    return Base(table, total, distinct), counts.filter(F.col("c") < least)


def score(docs: DataFrame, key: str = "doc_id", text: str = "text", depth: int = 6, share: int = 1 << 16,
          heavy: int = 1 << 17) -> DataFrame:
    """Scores of every text: (key, held_out, n_tokens, n_known, train_tokens, base_score, score,
    bits_per_byte). Texts whose crc32(key) modulo 7 is not 2 are learned from.

    Scores are of the text with A-Z in lower case and its end. Null text counts as
    empty (one token, its end); a null key counts as the empty key (learned from);
    repeated rows are learned from and scored one by one; an empty table gives an
    empty result, and without any training text the scores are those of no counts;
    other columns are not read.
    """
    k = F.col(f"`{key}`")
    body = docs.select(F.monotonically_increasing_id().alias("id"), k.alias("k"), (crc_mod(k, 7) == 2).alias("held_out"),
                       F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("t"))
    learned = body.filter(~F.col("held_out")).select("t")
    trunk, weights, branches = train_trunk(learned, depth, share)
    base, light = train_base(learned, heavy)
    end = base.distinct > 0
    ends = learned.count()
    sc = ship(docs.sparkSession)
    sent, full = sc.broadcast(base.heavy), sc.broadcast(weights.score)
    weights.score = weights.score[:0]
    outer = sc.broadcast(weights)
    kind = body.schema["k"].dataType.simpleString()
    doc = f"id long, k {kind}, held_out boolean, n_tokens long, n_known long, logs double"
    fields = ["id", "k", "held_out", "n_tokens", "n_known", "logs", "slice", "t", "w", "m", "block", "ask"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gains = {w: math.log10(c + 1) for w, c in sent.value.items()}
        for batch in batches:
            kinds = [pa.int64(), batch.schema.field(1).type, pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.int64(),
                     pa.string(), pa.string(), pa.int64(), pa.int32(), pa.binary()]

            def rows(n: int, **given) -> pa.RecordBatch:
                return pa.RecordBatch.from_arrays([given[f] if f in given else pa.nulls(n, s) for f, s in zip(fields, kinds)], fields)

            at = 0
            for texts in slices(batch.column(3).to_pylist(), SCORED_CHARS):
                ids = batch.column(0).slice(at, len(texts)).to_pylist()
                got, owner, rare, times = [], [], [], []
                for i, t in zip(ids, texts):
                    total, seen, gain = 1, 0, 0.0
                    for w, m in Counter(t.encode("utf-8", "surrogatepass").lower().split()).items():
                        total += m
                        g = gains.get(w)
                        if g is None:
                            owner.append(i)
                            rare.append(w)
                            times.append(m)
                        else:
                            seen += m
                            gain += m * g
                    got.append((total, seen, gain))
                cols = list(zip(*got))
                yield rows(len(texts), id=batch.column(0).slice(at, len(texts)), k=batch.column(1).slice(at, len(texts)),
                           held_out=batch.column(2).slice(at, len(texts)), n_tokens=pa.array(cols[0], pa.int64()),
                           n_known=pa.array(cols[1], pa.int64()), logs=pa.array(cols[2], pa.float64()),
                           slice=pa.array([ids[0]] * len(texts), pa.int64()), t=pa.array(texts, pa.string()))
                if rare:
                    yield rows(len(rare), id=pa.array(owner, pa.int64()), w=pa.array(rare, pa.binary()).cast(pa.string()),
                               m=pa.array(times, pa.int64()))
                asks = list(asked(trunk.value, texts))
                if asks:
                    yield rows(len(asks), slice=pa.array([ids[0]] * len(asks), pa.int64()),
                               block=pa.array([b for b, _ in asks], pa.int32()), ask=pa.array([a for _, a in asks], pa.binary()))
                at += len(texts)

    def answer(left: pa.Table, right: pa.Table) -> pa.Table:
        asks = [from_planes([x]) for x in left.column("ask").to_pylist()]
        known, counts = (from_planes(right.column(c).to_pylist()) for c in "gn")
        g = np.unique(np.concatenate([known, *asks]))
        n = np.zeros(len(g))
        n[np.searchsorted(g, known)] = counts
        logs = gram_logs(trunk.value, outer.value, g, n).astype(np.float32) if asks else None
        return pa.table({"slice": left.column("slice"), "block": left.column("block"),
                         "logs": pa.array([logs[np.searchsorted(g, a)].tobytes() for a in asks], pa.binary())})

    def close(left: pa.Table, right: pa.Table) -> pa.Table:
        answers = dict(zip(right.column("block").to_pylist(), right.column("logs").to_pylist()))
        logs, sizes = whole_scores(trunk.value, full.value, left.column("t").to_pylist(), answers)
        return left.drop_columns(["t", "slice"]).append_column("n_bytes", pa.array(sizes)).append_column("score", pa.array(logs))

    out = settle(body.mapInArrow(read, f"{doc}, slice long, t string, w string, m long, block int, ask binary"), "scored", "zstd")
    answers = (out.filter("ask is not null").select("slice", "block", "ask").groupBy("block")
               .cogroup(branches.groupBy("block")).applyInArrow(answer, "slice long, block int, logs binary"))
    scored = (out.filter("t is not null").select(*fields[:8]).groupBy("slice")
              .cogroup(answers.groupBy("slice")).applyInArrow(close, f"{doc}, n_bytes long, score double"))
    rare = (out.filter("w is not null").select("id", "w", "m").join(light, "w").groupBy("id")
            .agg(F.sum("m").alias("more"), F.sum(F.col("m") * F.log10(F.col("c") + 1)).alias("gain")))
    df = scored.join(rare, "id", "left")
    gain = F.col("logs") + F.coalesce("gain", F.lit(0.0)) + F.lit(math.log10(ends + 1))
    return df.select(
        F.col("k").alias(key), "held_out", "n_tokens",
        (F.col("n_known") + F.coalesce("more", F.lit(0)) + F.lit(int(end and ends > 0))).alias("n_known"),
        F.lit(base.total).cast("long").alias("train_tokens"),
        (gain - F.col("n_tokens") * F.lit(math.log10(base.total + base.distinct + 1))).alias("base_score"),
        "score", (-F.col("score") * math.log2(10) / F.greatest("n_bytes", F.lit(1))).alias("bits_per_byte"))
