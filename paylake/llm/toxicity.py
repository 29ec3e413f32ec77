"""Toxic passages by maximum-scoring segments.

Token scores are log-odds of toxic against clean text, smoothed by a Dirichlet
prior that follows the overall token frequencies. In every text a linear scan
finds all maximal-scoring segments (disjoint passages that cannot be extended or
shortened without loss). Their scores follow an extreme-value law on clean text;
its parameters, fitted on all clean training texts, turn the segments into an
expected number of chance hits, and a logistic fit on all training texts into a
probability.

Tokens are hashed into 2**18 classes, so the score table has a fixed size at any
corpus size, and every labelled training row counts.
"""
from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylake.llm.common import crc_mod, settle, ship

CLASSES = 1 << 18
PRIOR = 2000.0      # Dirichlet mass, spread over the classes by their overall frequency
CAUTION = 2.0       # standard errors taken off a log-odds before it counts
DRIFT = 0.5         # score a neutral token costs: a passage must be dense in marked tokens
BINS = 240          # bins of the evidence for the logistic fit
STEP = 0.25
BROADCAST_LABELS = 2_000_000  # labels (16 bytes each) broadcast up to this count, shuffled beyond


def token_classes(text: Column) -> Column:
    """Class of every token: letters and digits of any script, lower case."""
    tokens = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}']+"), "")
    return F.transform(tokens, lambda t: F.pmod(F.xxhash64(t), F.lit(CLASSES)).cast("int"))


@dataclass
class Scorer:
    table: np.ndarray   # score of each token class
    decay: float = 1.0  # lambda of the extreme-value law
    scale: float = 1.0  # K of the extreme-value law
    slope: float = 1.0
    offset: float = 0.0


def lexicon(counts: list[tuple[int, int, int]], prior: float = PRIOR, caution: float = CAUTION,
            drift: float = DRIFT) -> np.ndarray:
    """Scores from (class, count in toxic, count in clean) rows.

    Log-odds with an informative Dirichlet prior, less ``caution`` standard errors
    towards zero, less ``drift``; a class without evidence costs ``drift``.
    """
    toxic, clean = np.zeros(CLASSES), np.zeros(CLASSES)
    for c, a, b in counts:
        toxic[c], clean[c] = a, b
    total = toxic.sum() + clean.sum()
    if not toxic.sum() or not clean.sum():
        return np.full(CLASSES, -drift)
    base = prior * (toxic + clean) / total + 0.01
    mass = base.sum()
    odds = (np.log((toxic + base) / (toxic.sum() + mass - toxic - base))
            - np.log((clean + base) / (clean.sum() + mass - clean - base)))
    error = np.sqrt(1 / (toxic + base) + 1 / (clean + base))
    sure = np.sign(odds) * np.maximum(np.abs(odds) - caution * error, 0.0)
    return np.minimum(sure, 8.0) - drift


def decay_of(table: np.ndarray, clean: np.ndarray) -> float:
    """The positive root of E[exp(lambda * score)] = 1 over clean tokens (Karlin and Altschul)."""
    p = (clean + 1e-3) / (clean + 1e-3).sum()
    if (table > 0).sum() == 0 or (p * table).sum() >= 0:
        return 1.0
    low, high = 1e-3, 1.0
    while (p * np.exp(np.minimum(high * table, 700))).sum() < 1 and high < 64:
        high *= 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if (p * np.exp(np.minimum(mid * table, 700))).sum() < 1 else (low, mid)
    return (low + high) / 2


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (start, end, score), by Ruzzo and Tompa's scan.

    Neighbouring tokens of one sign act as one, so the scan steps over runs; a
    candidate is (start, end, sum before it, sum at its end).
    """
    if not len(scores):
        return []
    positive = scores > 0
    if not positive.any():
        return []
    cuts = np.flatnonzero(np.diff(positive)) + 1
    starts = np.concatenate([[0], cuts])
    ends = np.concatenate([cuts, [len(scores)]])
    sums = np.concatenate([[0.0], np.cumsum(scores)])
    kept: list[tuple[int, int, float, float]] = []
    below: list[int] = []  # for each candidate the nearest earlier one with a smaller left sum, or -1
    for s, e in zip(starts[positive[starts]].tolist(), ends[positive[starts]].tolist()):
        left, right = float(sums[s]), float(sums[e])
        start = s
        while True:
            j = len(kept) - 1
            while j >= 0 and kept[j][2] >= left:
                j = below[j]
            if j < 0 or kept[j][3] >= right:
                kept.append((start, e, left, right))
                below.append(j)
                break
            start, left = kept[j][0], kept[j][2]
            del kept[j:]
            del below[j:]
    return [(s, e, r - l) for s, e, l, r in kept]


def evidence(found: list[tuple[int, int, float]], n: int, scorer: Scorer) -> float:
    """Minus the log of the expected number of chance hits, summed over significant
    segments (those expected less than once in a text of this length)."""
    space = math.log(max(scorer.scale * max(n, 1), 1e-300))
    return sum(max(0.0, scorer.decay * s - space) for _, _, s in found)


def _class_rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(f"`{key}`").alias("k"), token_classes(F.col(f"`{text}`")).alias("c"))


def passages(docs: DataFrame, scorer: Scorer, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(k, n, best, evidence, passages): tokens, highest segment score, summed evidence and the
    significant segments as start:end token ranges."""
    sent = ship(docs.sparkSession).broadcast(scorer)
    kind = docs.select(F.col(f"`{key}`")).schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = sent.value
        for batch in batches:
            lists = batch.column(1)
            offsets = lists.offsets.to_numpy()
            score = s.table[lists.values.to_numpy(zero_copy_only=False)]
            marked = np.concatenate([[0], np.cumsum(score > 0)])
            rows = []
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                found = segments(score[a:b]) if marked[b] > marked[a] else []
                space = math.log(max(s.scale * max(b - a, 1), 1e-300))
                rows.append((b - a, max((x[2] for x in found), default=0.0), evidence(found, b - a, s),
                             ",".join(f"{x}:{y}" for x, y, z in found if s.decay * z > space)))
            cols = list(zip(*rows)) or [()] * 4
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.float64()),
                                              pa.array(cols[2], pa.float64()), pa.array(cols[3], pa.string())],
                                             ["k", "n", "best", "evidence", "passages"])

    return _class_rows(docs, key, text).mapInArrow(
        run, f"k {kind}, n long, best double, evidence double, passages string")


def _labelled(df: DataFrame, on: str, labels: DataFrame, key: str, label: str) -> DataFrame:
    """Rows with a known label (column y). Labels are broadcast only up to a counted size."""
    marks = (labels.filter(F.col(f"`{key}`").isNotNull() & F.col(f"`{label}`").isNotNull())
             .groupBy(F.col(f"`{key}`").alias("_id")).agg(F.max(F.col(f"`{label}`")).cast("int").alias("y")))
    if labels.count() <= BROADCAST_LABELS:
        marks = F.broadcast(marks)
    return df.join(marks, df[on] == F.col("_id")).drop("_id")


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> Scorer:
    """Fit on every labelled document whose crc32(key) is not divisible by 5."""
    rows = docs.filter(crc_mod(F.col(f"`{key}`"), 5) != 0)
    rows = _labelled(rows.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t")), "k", labels, key, label)
    tokens = rows.select("y", F.explode(token_classes(F.col("t"))).alias("c"))
    counts = [(r.c, r.a, r.b) for r in tokens.groupBy("c").agg(
        F.sum("y").alias("a"), F.sum(1 - F.col("y")).alias("b")).collect()]  # CLASSES rows at most
    scorer = Scorer(lexicon(counts))
    clean = np.zeros(CLASSES)
    for c, _, b in counts:
        clean[c] = b
    scorer.decay = decay_of(scorer.table, clean)
    found = settle(_labelled(passages(rows, scorer, "k", "t"), "k", labels, key, label), "evidence")
    # likelihood maximum of K for best scores x over texts of n tokens: P(X > x) = 1 - exp(-K n exp(-lambda x))
    fit = found.filter("y = 0 and n > 0").agg(
        F.count(F.lit(1)).alias("m"), F.sum(F.col("n") * F.exp(-F.lit(scorer.decay) * F.col("best"))).alias("w")).first()
    if fit.m:
        scorer.scale = fit.m / fit.w
    again = _labelled(passages(rows, scorer, "k", "t"), "k", labels, key, label)
    bins = again.groupBy(F.least(F.floor(F.col("evidence") / STEP), F.lit(BINS - 1)).alias("bin"), "y").count().collect()
    scorer.slope, scorer.offset = logistic([((r.bin + 0.5 * (r.bin > 0)) * STEP, r.y, r["count"]) for r in bins])
    return scorer


def logistic(rows: list[tuple[float, int, int]]) -> tuple[float, float]:
    """Weighted logistic fit (slope, offset) by Newton steps with a small ridge."""
    if not rows:
        return 1.0, -2.0
    x = np.array([r[0] for r in rows], float)
    y = np.array([r[1] for r in rows], float)
    w = np.array([r[2] for r in rows], float)
    beta = np.array([0.0, math.log((w @ y + 0.5) / (w @ (1 - y) + 0.5))])
    design = np.stack([x, np.ones_like(x)], 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-design @ beta))
        grad = design.T @ (w * (y - p)) - 0.01 * beta
        hess = (design * (w * p * (1 - p) + 1e-9)[:, None]).T @ design + 0.01 * np.eye(2)
        move = np.linalg.solve(hess, grad)
        beta = beta + np.clip(move, -2, 2)
        if np.abs(move).max() < 1e-8:
            break
    return max(float(beta[0]), 1e-3), float(beta[1])


def score(docs: DataFrame, scorer: Scorer, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, held_out, score, predicted, passages) of every document.

    Null text counts as empty: no passage, the score of no evidence. A null key is
    never a training row (its crc32 is that of the empty text); repeated rows score
    alike; an empty table gives an empty result; other columns are not read.
    """
    p = 1 / (1 + F.exp(-(F.lit(scorer.slope) * F.col("evidence") + F.lit(scorer.offset))))
    df = passages(docs, scorer, key, text)
    return df.select(F.col("k").alias(key), (crc_mod(F.col("k"), 5) == 0).alias("held_out"), p.alias("score"),
                     (p >= 0.5).cast("int").alias("predicted"), "passages")
