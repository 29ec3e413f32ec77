"""Secret scans: pattern spans plus a linear-chain conditional random field.

Tokens are tagged O, B or I (outside, begin, inside a secret). A tag's score
adds weights of the token's own shape, of the categories of the neighbouring
tokens and of features of the whole file; tag pairs have transition scores. The
best tag sequence is found by Viterbi.

Most tokens are outside beyond doubt: where a token's own preference for O
exceeds all that any neighbouring tags could gain, every best path is in O
there. Viterbi therefore runs only on the stretches between such tokens; the
result is that of the whole sequence.

The model is fitted on a bounded sample (parameters ``positive_docs``,
``other_docs``, ``windows_per_doc``), with the pattern spans as labels; texts
are scanned whole, in batches, with a bounded token cache.
"""
from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylake.llm.bpe_trie import slices
from paylake.llm.common import ship

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # maximal runs, so the length can be in the pattern
LIKELY = r"(?i)(password|passwd|secret|token|api_?key)|AKIA[A-Z0-9]{16}|[0-9a-f]{24}"  # JVM preselection of the sample
TOKEN = re.compile(r"[\w+/.\-]+|[^\w\s+/.\-]")
O, B, I = 0, 1, 2
REDACTED_CHARS = 1_000_000  # characters tagged and rewritten at once by redact
PAD = 3                 # outside tokens between texts
CACHE_TOKENS = 300_000
WINDOW = 12             # tokens on either side of a training span

KEYWORDS = frozenset("password passwd pwd pass secret token apikey api_key key bearer auth credential "
                     "credentials private access login".split())
CATEGORIES = ("edge", "keyword", "equals", "colon", "quote", "punct", "word", "number", "mixed", "long")
HEX_LETTERS = frozenset("0123456789abcdef")
SHAPES = 64
FIRST_CATEGORY = 46
FILE_FEATURES = 9


def base_spans(text: str) -> list[tuple[int, int, int, int, int]]:
    """(start, kind, end, value start, value end) of every pattern match, by start and kind."""
    found = [(m.start(), 0, m.end(), m.start(2), m.end(2)) for m in ASSIGN.finditer(text)
             if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), m.start(), m.end()) for m in ACCESS.finditer(text)
                  if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end(), m.start(), m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def category(token: str) -> int:
    if token == "=":
        return 2
    if token == ":":
        return 3
    if token in "\"'`":
        return 4
    bare = token.strip("._-+/").lower()
    if not bare:
        return 5
    if bare in KEYWORDS or bare.split("_")[-1] in KEYWORDS:
        return 1
    if len(token) > 15:
        return 9
    digits = sum(map(str.isdigit, bare))
    if digits == 0:
        return 6 if bare.isalnum() else 5
    return 7 if digits == len(bare) else 8


def shape(token: str) -> list[int]:
    """Ids (below SHAPES) of the whole token's own features; the category comes last."""
    n = len(token)
    low, up = any(map(str.islower, token)), any(map(str.isupper, token))
    digits = sum(map(str.isdigit, token))
    turns, inner, last = -1, False, ""
    for c in token:  # one pass without a list: a token can be a whole text
        kind = "d" if c.isdigit() else "u" if c.isupper() else "l" if c.isalpha() else "s"
        inner = inner or last == "s"
        turns += kind != last
        last = kind
    hexa = n >= 8 and all(c in "0123456789abcdef" for c in token)
    out = [0,
           1 + min(8, n // 4),
           10 + low + 2 * up + 4 * (digits > 0),
           18 + min(4, 5 * digits // n),
           23 + min(7, turns // 2 if turns < 12 else 6 + turns // 24),
           32 + min(4, 8 * len(set(token)) // n)]
    if hexa:
        out.append(40)
    if token.startswith("AKIA"):
        out.append(41)
    if inner:
        out.append(42)
    if up and low and digits:
        out.append(43 + (n >= 12))
    if n >= 12 and turns >= 6:
        out.append(45)
    return out + [FIRST_CATEGORY + category(token)]


def file_features(text: str, tokens: int) -> list[int]:
    """Ids (below FILE_FEATURES): text length, share of '=' and ':' and share of quotes."""
    n = max(1, len(text))
    marks = (text.count("=") + text.count(":")) / max(1, tokens)
    quotes = (text.count('"') + text.count("'")) / max(1, tokens)
    return [min(2, n // 2000), 3 + (marks > 0.005) + (marks > 0.05), 6 + (quotes > 0.005) + (quotes > 0.05)]


@dataclass
class Model:
    own: np.ndarray      # SHAPES x 3
    near: np.ndarray     # 4 x categories x 3: one, two, three before, one after
    file: np.ndarray     # FILE_FEATURES x 3
    step: np.ndarray     # 3 x 3, from, to

    @staticmethod
    def empty() -> Model:
        c = len(CATEGORIES)
        return Model(np.zeros((SHAPES, 3)), np.zeros((4, c, 3)), np.zeros((FILE_FEATURES, 3)), np.zeros((3, 3)))


def training_windows(text: str, most: int) -> list[tuple[list[list[int]], list[int], list[int]]]:
    """Up to ``most`` stretches of a text: the tokens' shapes, their tags, file features."""
    found = list(TOKEN.finditer(text))
    if not found:
        return []
    starts = np.array([m.start() for m in found])
    tags = np.zeros(len(found), int)
    centres = []
    for _, _, _, a, b in base_spans(text):
        lo, hi = np.searchsorted(starts, [a, b])
        if hi > lo:
            tags[lo:hi] = I
            tags[lo] = B
            centres.append((lo, hi))
    spots = [(max(0, lo - WINDOW), min(len(found), min(hi, lo + WINDOW) + WINDOW)) for lo, hi in centres[:most - 1]]
    middle = len(found) // 2
    spots.append((max(0, middle - WINDOW), min(len(found), middle + WINDOW)))
    features = file_features(text, len(found))
    out = []
    for a, b in spots:
        pairs = [(m.group(), int(y)) for m, y in zip(found[a:b], tags[a:b])]
        out.append(pairs)
        # the same stretch without the mark before the value, so that shape and
        # neighbouring words carry the decision as well
        bare = [(t, y) for t, y in pairs if y != O or t not in "=:\"'"]
        if any(y for _, y in pairs) and len(bare) < len(pairs):
            out.append(bare)
    return [([shape(t) for t, _ in p], [y for _, y in p], features) for p in out]


def fit(windows: list[tuple[list[list[int]], list[int], list[int]]], rounds: int = 120, rate: float = 0.1,
        shrink: float = 1e-4) -> Model:
    """Maximum likelihood by Adam; forward-backward over all windows at once.
    The chain starts and ends in an outside token."""
    n, length = len(windows), max(len(w[0]) for w in windows) + 1  # the last column is an outside token
    c = len(CATEGORIES)
    own = np.zeros((n, length, SHAPES))
    near = np.zeros((n, length, 4), int)
    file = np.zeros((n, FILE_FEATURES))
    tags = np.zeros((n, length), int)
    mask = np.zeros((n, length))
    for k, (tokens, tag, features) in enumerate(windows):
        cats = [0] * PAD + [ids[-1] - FIRST_CATEGORY for ids in tokens] + [0]
        for t, ids in enumerate(tokens):
            own[k, t, ids] = 1
            near[k, t] = cats[t + PAD - 1], cats[t + PAD - 2], cats[t + PAD - 3], cats[t + PAD + 1]
        tags[k, :len(tag)], mask[k, :len(tag)] = tag, 1
        file[k, features] = 1
    shapes = [(SHAPES, 3), (4, c, 3), (FILE_FEATURES, 3), (3, 3)]
    weights = [np.zeros(s) for s in shapes]
    first, second = [np.zeros(s) for s in shapes], [np.zeros(s) for s in shapes]
    barred = np.zeros((3, 3))
    barred[O, I] = -12.0  # a secret starts with B
    one = np.eye(3)
    for turn in range(1, rounds + 1):
        w_own, w_near, w_file, w_step = weights
        score = own @ w_own + sum(w_near[j][near[:, :, j]] for j in range(4)) + (file @ w_file)[:, None, :]
        score = np.where(mask[..., None] > 0, score, np.array([0.0, -40.0, -40.0]))
        step = w_step + barred
        ahead, behind = np.zeros((n, length, 3)), np.zeros((n, length, 3))
        ahead[:, 0] = score[:, 0] + step[O]
        for t in range(1, length):
            ahead[:, t] = score[:, t] + np.logaddexp.reduce(ahead[:, t - 1, :, None] + step, axis=1)
        for t in range(length - 2, -1, -1):
            behind[:, t] = np.logaddexp.reduce(step + (score[:, t + 1] + behind[:, t + 1])[:, None, :], axis=2)
        total = np.logaddexp.reduce(ahead[:, -1], axis=1)
        marginal = np.exp(ahead + behind - total[:, None, None])
        off = (one[tags] - marginal) * mask[..., None]
        grad = [np.einsum("kts,kty->sy", own, off), np.zeros((4, c, 3)), np.einsum("kf,kty->fy", file, off),
                np.zeros((3, 3))]
        for j in range(4):
            np.add.at(grad[1][j], near[:, :, j].ravel(), off.reshape(-1, 3))
        pair = np.exp(ahead[:, :-1, :, None] + step + (score[:, 1:] + behind[:, 1:])[:, :, None, :]
                      - total[:, None, None, None]) * mask[:, :-1, None, None]
        seen = one[tags[:, :-1]][..., None] * one[tags[:, 1:]][..., None, :] * mask[:, :-1, None, None]
        grad[3] = (seen - pair).sum((0, 1))
        for k, g in enumerate(grad):
            g = g / n - shrink * weights[k]
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            weights[k] += rate * (first[k] / (1 - 0.9 ** turn)) / (np.sqrt(second[k] / (1 - 0.999 ** turn)) + 1e-8)
    return Model(*weights[:3], weights[3] + barred)


class Tagger:
    def __init__(self, model: Model):
        self.m = model
        self.index: dict[str, int] = {}                  # token -> profile
        self.profiles: dict[tuple, int] = {}             # (shape ids, category) -> profile
        self.plain: dict[tuple, int] = {}                # the same for words, by length, variety and case
        self.own: list[np.ndarray] = []
        self.cat: list[int] = []
        s = model.step
        # what a tag other than O can gain at most from its neighbours' tags, by the next tag
        self.gain = np.array([max(s[a, x] + s[x, b] - s[a, O] for a in (O, B, I) for x in (B, I)) for b in (O, B, I)])
        self.rejoin = min(s[B, b] - s[I, b] for b in (O, B, I))

    def _profile(self, token: str) -> int:
        key = (*shape(token), category(token))
        if key not in self.profiles:
            self.profiles[key] = len(self.own)
            self.own.append(self.m.own[list(key[:-1])].sum(0))
            self.cat.append(key[-1])
        return self.profiles[key]

    def _learn(self, tokens: set[str]) -> None:
        if len(self.index) > CACHE_TOKENS:
            self.index.clear()
        for t in tokens:
            word = t[:-1] if t[-1] == "." else t
            if word.isalpha() and (word.islower() or word.istitle()) and word.lower() not in KEYWORDS:
                letters = set(t)  # such words of one length and variety share a profile
                key = (len(t), len(letters), word.islower(), t[-1] == ".", letters <= HEX_LETTERS)
                if key not in self.plain:
                    self.plain[key] = self._profile(t)
                self.index[t] = self.plain[key]
            else:
                self.index[t] = self._profile(t)

    def scores(self, tokens: list[list[str]], texts: list[str]) -> np.ndarray:
        """Tag scores of the texts' tokens in a row, PAD outside tokens after each."""
        if len(self.index) > CACHE_TOKENS:
            self._learn(set())
        new: set[str] = set()
        for ts in tokens:
            new.update(set(ts).difference(self.index))
        self._learn(new)
        n = sum(map(len, tokens)) + PAD * len(tokens)
        where = np.full(n, -1, np.int64)
        extra = np.zeros((n, 3))
        at = 0
        for ts, text in zip(tokens, texts):
            where[at:at + len(ts)] = list(map(self.index.__getitem__, ts))
            extra[at:at + len(ts)] = self.m.file[file_features(text, len(ts))].sum(0)
            at += len(ts) + PAD
        pad = where < 0
        own = np.array([*self.own, np.zeros(3)])
        cat = np.array([*self.cat, 0])[where]
        score = own[where] + extra
        for j, lag in enumerate((1, 2, 3)):
            before = np.zeros(n, int)
            before[lag:] = cat[:-lag]
            score += self.m.near[j][before]
        after = np.zeros(n, int)
        after[:-1] = cat[1:]
        score += self.m.near[3][after]
        score[pad] = 0.0, -1e6, -1e6
        return score

    def certain(self, score: np.ndarray) -> np.ndarray:
        """Tokens that are outside on every best path. Turning such a token's tag
        into O (and a following I into B) raises the score whatever the tags around."""
        s = self.m.step
        nxt = np.vstack([score[1:], [[0.0, -1e6, -1e6]]])
        loss = np.maximum.reduce([np.full(len(score), self.gain[O] - s[O, O]), np.full(len(score), self.gain[B] - s[O, B]),
                                  self.gain[I] - s[O, B] - (nxt[:, B] - nxt[:, I]) - self.rejoin])
        return score[:, O] - np.maximum(score[:, B], score[:, I]) > np.maximum(loss, 0)

    def viterbi(self, score: np.ndarray) -> list[int]:
        """Best tags of a stretch with outside tokens before and after it."""
        s = self.m.step.tolist()
        best, back = [s[O][y] + score[0][y] for y in range(3)], []
        for row in score[1:].tolist():
            kept, came = [], []
            for y in range(3):
                x = max(range(3), key=lambda a: best[a] + s[a][y])
                came.append(x)
                kept.append(best[x] + s[x][y] + row[y])
            best = kept
            back.append(came)
        y = max(range(3), key=lambda a: best[a] + s[a][O])
        tags = [y]
        for came in reversed(back):
            y = came[y]
            tags.append(y)
        return tags[::-1]

    def spans(self, texts: list[str]) -> list[list[tuple[int, int]]]:
        """(start, end) of every tagged secret, by text."""
        tokens = [TOKEN.findall(t) for t in texts]
        out: list[list[tuple[int, int]]] = [[] for _ in texts]
        if not any(tokens):
            return out
        score = self.scores(tokens, texts)
        open_ = np.flatnonzero(~self.certain(score))
        if not len(open_):
            return out
        starts = np.cumsum([0] + [len(t) + PAD for t in tokens])
        for run in np.split(open_, np.flatnonzero(np.diff(open_) > 1) + 1):
            tags = self.viterbi(score[run[0]:run[-1] + 1])
            if not any(tags):
                continue
            k = int(np.searchsorted(starts, run[0], "right")) - 1
            out[k].extend((int(i - starts[k]), tag) for i, tag in zip(run, tags) if tag != O)
        for k, marked in enumerate(out):
            if marked:
                out[k] = self._merge(texts[k], marked)
        return out

    @staticmethod
    def _merge(text: str, marked: list[tuple[int, int]]) -> list[tuple[int, int]]:
        want = dict(marked)
        spans: list[list[int]] = []
        last = -2
        for i, m in enumerate(TOKEN.finditer(text)):
            if i in want:
                if want[i] == B or last != i - 1:
                    spans.append([m.start(), m.end()])
                else:
                    spans[-1][1] = m.end()
                last = i
        return [(a, b - (len(text[a:b]) - len(text[a:b].rstrip(".")))) for a, b in spans if text[a:b].rstrip(".")]


def train(docs: DataFrame, key: str = "doc_id", text: str = "text", positive_docs: int = 400, other_docs: int = 200,
          windows_per_doc: int = 6) -> Model | None:
    """Fit on a hash sample of about ``positive_docs`` documents with a likely secret and
    ``other_docs`` of any kind (twice as many at most). The sampling rate follows from one
    row of counts, so no task gathers texts; at most 2 x (positive_docs + other_docs) x
    windows_per_doc x 2 short windows reach the driver. None if no secret is labelled."""
    ship(docs.sparkSession)
    body = docs.select(F.col(f"`{key}`").alias("k"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("t"))
    likely = F.col("t").rlike(LIKELY)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [w for t in batch.column(0).to_pylist() for w in training_windows(t, windows_per_doc)]
            yield pa.RecordBatch.from_arrays([
                pa.array([r[0] for r in rows], pa.list_(pa.list_(pa.int32()))), pa.array([r[1] for r in rows], pa.list_(pa.int32())),
                pa.array([r[2] for r in rows], pa.list_(pa.int32()))], ["tokens", "tags", "file"])

    count = body.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(likely.cast("long")), F.lit(0)).alias("m")).first()
    place = F.pmod(F.xxhash64("k", "t"), F.lit(1 << 40))
    windows = []
    for part, want, of in ((body.filter(likely), positive_docs, count.m), (body, other_docs, count.n)):
        some = part.filter(place < int((1 << 40) * min(1.0, want / max(1, of)))).select("t")
        got = some.mapInArrow(cut, "tokens array<array<int>>, tags array<int>, file array<int>")
        windows += [(list(r.tokens), list(r.tags), list(r.file)) for r in got.limit(4 * want * windows_per_doc).collect()]
    windows.sort()
    if not any(any(w[1]) for w in windows):
        return None
    return fit(windows)


def scan(docs: DataFrame, model: Model | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """All secret spans of every text: (key, n_assign, n_access, n_hex, base_sha256, spans).

    ``spans`` lists kind:start:end by start, then kind (assign, access, hex, crf),
    in code points with the end exclusive. Pattern spans always stay; ``crf`` spans
    are those of the field that overlap none of them. Null text counts as empty (no
    span); a null key stays null; repeated rows are scanned alike; an empty table
    gives an empty result; other columns are not read, so names cannot clash.
    """
    sent = ship(docs.sparkSession).broadcast(model or Model.empty())
    fitted = model is not None
    kind = docs.select(F.col(f"`{key}`")).schema[0].dataType.simpleString()
    names = ["k", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(sent.value)
        for batch in batches:
            at = 0
            for texts in slices([t or "" for t in batch.column(1).to_pylist()]):
                tagged = tagger.spans(texts) if fitted else [[] for _ in texts]
                rows = []
                for text_, extra in zip(texts, tagged):
                    base = base_spans(text_)
                    listed = [(a, k, b) for a, k, b, _, _ in base]
                    every = sorted(listed + [(a, 3, b) for a, b in extra
                                             if not any(a < y and x < b for x, _, y in listed)])
                    show = [",".join(f"{(*KINDS, 'crf')[k]}:{a}:{b}" for a, k, b in part) for part in (listed, every)]
                    counts = [sum(k == j for _, k, _ in listed) for j in range(3)]
                    rows.append((*counts, hashlib.sha256(show[0].encode()).hexdigest(), show[1]))
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(texts)), *[pa.array(c, pa.int64()) for c in cols[:3]],
                     pa.array(cols[3]), pa.array(cols[4])], names)
                at += len(texts)

    out = docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t")).mapInArrow(
        run, f"k {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
    return out.withColumnRenamed("k", key)


def mask_spans(text: str, spans: str, mark: str = "[SECRET]") -> str:
    """The text with every span (overlapping ones joined) replaced by ``mark``."""
    out, at = [], 0
    for a, b in sorted((int(a), int(b)) for _, a, b in (s.split(":") for s in spans.split(","))) if spans else []:
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join(out) + text[at:]


def redact(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """``docs`` with every secret replaced; null texts stay null, columns and other values unchanged.
    A column ``n_chars`` follows the new text's length. Rows pass one by one, so nulls in other
    columns, repeated rows and ties change nothing; an empty table gives an empty result; a
    very long text is a slice of its own; other columns are passed by place, whatever their names."""
    sent = ship(docs.sparkSession).broadcast(model or Model.empty())
    fitted = model is not None
    place = docs.columns.index(text)
    sizes = docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(sent.value)
        for batch in batches:
            at = 0
            whole = batch.column(place).to_pylist()
            for texts in slices((t or "" for t in whole), REDACTED_CHARS):
                tagged = tagger.spans(texts) if fitted else [[] for _ in texts]
                clean = []
                for text_, extra in zip(texts, tagged):
                    spans = [f"x:{s[0]}:{s[2]}" for s in base_spans(text_)] + [f"x:{a}:{b}" for a, b in extra]
                    clean.append(mask_spans(text_, ",".join(spans)))
                clean = [None if was is None else c for was, c in zip(whole[at:], clean)]
                cols = [batch.column(i).slice(at, len(texts)) for i in range(batch.num_columns)]
                cols[place] = pa.array(clean, batch.schema.field(place).type)
                if sizes is not None:
                    cols[sizes] = pa.array([c if t is None or t == w else len(t) for c, t, w in zip(
                        cols[sizes].to_pylist(), clean, whole[at:])], batch.schema.field(sizes).type)
                yield pa.RecordBatch.from_arrays(cols, schema=batch.schema)
                at += len(texts)

    return docs.mapInArrow(run, docs.schema)
