"""BPE encoding by a prefix-sharing trie.

Byte-pair merges have a prefix property: the encoding of a prefix is the
encoding of a shorter prefix followed by one token, the *last token*. The last
token of every trie node therefore follows from the last tokens on its path:
it is the token that ends there and that merging would not have joined with
the last token before it. Distinct words of a batch go into one trie; a
depth-first walk fills in the last tokens, so a prefix that many words share is
encoded once, and each word's ids are read off backwards.

Tables of the vocabulary have a fixed size (that of the tokenizer file) and are
broadcast; texts stream through ``mapInArrow`` in slices, and what a worker
remembers of earlier words is bounded in bytes, so a task's memory does not grow
with the input. The walk keeps one state per letter of the path it is on, so a word
of n letters takes memory in proportion to n.
"""
from __future__ import annotations

import gc
import hashlib
import json
import unicodedata
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylake.llm.common import ship

# fixed value: the pre-tokenizer's pattern, as stated in the tokenizer file
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
END = "</w>"
SEPARATORS = "\x1c\x1d\x1e\x1f"
CACHE_BYTES = 60_000_000   # of words and chunks remembered by a task, twice at most
CACHE_PAIRS = 150_000      # boundaries remembered by a worker
SLICE_CHARS = 4_000_000    # characters of one slice, unless stated
TRIE_CHARS = 1_000_000     # characters whose words share one trie


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies:
    printable Latin-1 bytes are themselves, the others follow from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    letter = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return [letter[b] for b in range(256)]


class Vocabulary:
    """Token ids, and for each merged token its two halves and its rank."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            content = f.read()
        self.digest = hashlib.sha256(content.encode()).hexdigest()
        spec = json.loads(content)
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.special: dict[str, int] = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.text: dict[int, str] = {i: s for s, i in self.ids.items()} | {i: s for s, i in self.special.items()}
        self.rank: dict[int, int] = {}
        self.halves: dict[int, tuple[int, int]] = {}
        self.merged: dict[tuple[int, int], int] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            a, b, c = self.ids[left], self.ids[right], self.ids[left + right]
            self.merged[a, b] = rank
            if c not in self.halves:
                self.rank[c], self.halves[c] = rank, (a, b)
        # tokens by their letters read backwards, so that one walk from the end of a
        # prefix meets every token that ends there; word-final tokens apart
        self.inner: dict = {}
        self.final: dict = {}
        for name, token in self.ids.items():
            half = self.halves.get(token)
            if half is not None and self.merged[half] != self.rank[token]:
                continue
            node, letters = (self.final, name[:-len(END)]) if name.endswith(END) else (self.inner, name)
            for c in reversed(letters):
                node = node.setdefault(c, {})
            node[END] = token


class TrieEncoder:
    """Encodes sets of words. What it remembers has two generations: when the younger one
    reaches ``CACHE_BYTES`` it becomes the older one, and what the older one held is forgotten."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.letters = byte_letters()
        self.pieces = regex.compile(PIECES)
        self.parted = regex.compile("(" + "|".join(map(regex.escape, vocabulary.special)) + ")")
        self.width = max(vocabulary.text, default=0) + 1
        self.stays: dict[int, bool] = {}
        self.forget()

    def forget(self) -> None:
        """Free what is remembered: a worker goes on to tasks of other kinds."""
        self.older: tuple[dict, dict, dict] = ({}, {}, {})
        self._renew()

    def _renew(self) -> None:
        self.words: dict[str, Sequence[int]] = {}
        self.ids: dict[str, str] = {}
        self.shown: dict[str, str] = {}
        self.bare: set[str] = set()  # chunks without any piece
        self.bytes = 0

    def apart(self, a: int, b: int) -> bool:
        """Whether merging leaves a boundary between neighbours ``a`` and ``b``.

        Undo the merges next to the boundary from the latest to the first; the
        boundary falls if at any stage the two tokens that touch it could have
        merged before the later of them was made.
        """
        v, x, y = self.v, a, b
        # a joint merge happens if its rank is below the rank at which either
        # side grows further; on equal rank the left pair goes first
        limit, strict = float("inf"), True
        while True:
            joint = v.merged.get((x, y))
            if joint is not None and (joint < limit or (joint == limit and not strict)):
                ok = False
                break
            rx, ry = v.rank.get(x, -1), v.rank.get(y, -1)
            if rx < 0 and ry < 0:
                ok = True
                break
            if rx > ry:
                x, limit, strict = v.halves[x][1], rx, True
            else:
                y, limit, strict = v.halves[y][0], ry, False
        if len(self.stays) > CACHE_PAIRS:
            self.stays.clear()
        self.stays[a * self.width + b] = ok
        return ok

    def _last(self, word: str, end: int, tokens: dict, back: list[tuple[int, int]]) -> tuple[int, int]:
        """Last token and its length for the prefix of length ``end``; ``back[d]`` is the
        state of the prefix of length d. Exactly one token fits."""
        node, start, stays, width = tokens, end, self.stays, self.width
        while start:
            start -= 1
            node = node.get(word[start])
            if node is None:
                break
            token = node.get(END)
            if token is not None:
                if start == 0:
                    return token, end
                before = back[start][0]
                ok = stays.get(before * width + token)
                if ok or ok is None and self.apart(before, token):
                    return token, end - start
        raise ValueError(f"no token ends {word[:end]!r}")

    def learn(self, words: set[str]) -> None:
        """Encode ``words`` (in byte letters) as a depth-first walk of their trie. The trie is
        held as its words in order, each leaving the path of the word before it where the two
        part, so the states of a shared prefix are computed once and kept on one path."""
        back: list[tuple[int, int]] = [(-1, 0)]
        last, inner, before = self._last, self.v.inner, ""
        for word in sorted(words):
            shared = 1
            for x, y in zip(before, word):
                if x != y:
                    break
                shared += 1
            del back[shared:]
            for end in range(len(back), len(word)):
                back.append(last(word, end, inner, back))
            self._read(word, back)
            before = word

    def _read(self, word: str, back: list[tuple[int, int]]) -> None:
        token, size = self._last(word, len(word), self.v.final, back)
        ids, at = [token], len(word) - size
        while at > 0:
            token, size = back[at]
            ids.append(token)
            at -= size
        ids.reverse()
        self.words[word] = ids
        self.bytes += 210 + len(word) + 8 * len(ids)

    def split(self, text: str) -> list[str]:
        """White-space chunks of the text in NFC and lower case (letter by letter:
        no final-sigma rule). No piece spans two chunks."""
        if not text.isascii():
            if not unicodedata.is_normalized("NFC", text):
                text = unicodedata.normalize("NFC", text)
            if "Σ" in text:
                text = text.replace("Σ", "σ")
        text = text.lower()
        if any(c in text for c in SEPARATORS):  # Python splits there, the pattern does not
            return [c for c in regex.split("[ \\n\\t\\r]", text) if c]
        return text.split()

    def _remember(self, chunks: set[str]) -> None:
        """Encode chunks not met before; all their new words share one trie."""
        pieces_of: dict[str, list[str]] = {}
        old_words, old_ids, old_shown = self.older
        for chunk in chunks:
            if chunk in old_ids:
                self._keep(chunk, old_ids[chunk], old_shown[chunk])
                continue
            pieces_of[chunk] = [
                piece if piece.isascii() and piece.isprintable()  # such bytes stand for themselves
                else "".join(map(self.letters.__getitem__, piece.encode())) for piece in self.pieces.findall(chunk)]
        new = {w for pieces in pieces_of.values() for w in pieces}.difference(self.words)
        for w in new.intersection(old_words):
            self.words[w] = old_words[w]
            self.bytes += 210 + len(w) + 8 * len(old_words[w])
        self.learn(new.difference(old_words))
        for chunk, pieces in pieces_of.items():
            ids = [i for w in pieces for i in self.words[w]]
            self._keep(chunk, " ".join(map(str, ids)), " ".join(map(self.v.text.__getitem__, ids)))

    def _keep(self, chunk: str, ids: str, shown: str) -> None:
        self.ids[chunk], self.shown[chunk] = ids, shown
        self.bytes += 350 + len(chunk) + len(ids) + len(shown)
        if not ids:
            self.bare.add(chunk)

    def encode(self, texts: list[str]) -> list[tuple[int, str, str]]:
        """(number of tokens, ids joined by spaces, decoded text) of each text."""
        if self.bytes > CACHE_BYTES:
            self.older = self.words, self.ids, self.shown
            self._renew()
        parted, new = [], set()
        for text in texts:
            if any(s in text for s in self.v.special):
                parts = [p if p in self.v.special else self.split(p) for p in self.parted.split(text)]
            else:
                parts = [self.split(text)]
            for p in parts:
                if not isinstance(p, str):
                    new.update(set(p).difference(self.ids))
            parted.append(parts)
        self._remember(new)
        out = []
        for parts in parted:
            ids, shown = [], []
            for p in parts:
                if isinstance(p, str):
                    ids.append(str(self.v.special[p]))
                    shown.append(p)
                    continue
                if self.bare:
                    p = [c for c in p if c not in self.bare]
                ids.extend(map(self.ids.__getitem__, p))
                shown.extend(map(self.shown.__getitem__, p))
            line = " ".join(ids)
            out.append((line.count(" ") + 1 if line else 0, line, " ".join(shown)))
        return out


_encoders: dict[str, TrieEncoder] = {}


def encoder_for(vocabulary: Vocabulary) -> TrieEncoder:
    """The encoder of this worker process, so that its tasks share the vocabulary's tables."""
    if vocabulary.digest not in _encoders:
        _encoders.clear()
        _encoders[vocabulary.digest] = TrieEncoder(vocabulary)
        gc.disable()  # the tables hold no cycles, and scanning them again and again is slow
    return _encoders[vocabulary.digest]


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def slices(texts: Iterable[str], limit: int = SLICE_CHARS) -> Iterator[list[str]]:
    """Consecutive runs of texts of about ``limit`` characters (one text at least)."""
    run, size = [], 0
    for t in texts:
        if run and size + len(t) > limit:
            yield run
            run, size = [], 0
        run.append(t)
        size += len(t)
    if run:
        yield run


def id_lists(got: list[tuple[int, str, str]]) -> pa.ListArray:
    """The ids of each text as one flat array with offsets."""
    ends = np.concatenate([[0], np.cumsum([g[0] for g in got])])
    flat = np.fromstring(" ".join(g[1] for g in got if g[1]), np.int32, sep=" ")
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))


def encode(docs: DataFrame, path: str | None = None, key: str = "doc_id", text: str = "text",
           ids: bool = True) -> DataFrame:
    """Encode every text: (key, n_tokens, token_ids array, ids_sha256, decoded_sha256).

    Null text counts as empty: no tokens, digests of the empty string. A null
    key stays null; repeated rows give repeated rows; an empty table gives an
    empty result; other columns of ``docs`` are not read, so their names cannot
    clash. ``ids=False`` leaves ``token_ids`` out and keeps the digests only.
    """
    vocabulary = ship(docs.sparkSession).broadcast(Vocabulary(path or default_path()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_for(vocabulary.value)
        for batch in batches:
            at = 0
            for texts in slices((t.as_py() or "" for t in batch.column(1)), TRIE_CHARS):
                got = encoder.encode(texts)
                cols = [batch.column(0).slice(at, len(texts)), pa.array([g[0] for g in got], pa.int64())]
                if ids:
                    cols.append(id_lists(got))
                cols += [pa.array([hashlib.sha256(g[k].encode()).hexdigest() for g in got]) for k in (1, 2)]
                at += len(texts)
                yield pa.RecordBatch.from_arrays(cols, names)
        encoder.forget()

    kind = docs.select(F.col(f"`{key}`")).schema[0].dataType.simpleString()
    names = ["k", "n_tokens", *(["token_ids"] if ids else []), "ids_sha256", "decoded_sha256"]
    schema = f"k {kind}, n_tokens long, " + "token_ids array<int>, " * ids + "ids_sha256 string, decoded_sha256 string"
    out = docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t")).mapInArrow(run, schema)
    return out.withColumnRenamed("k", key)
