"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

A text is normalised as the model file says (identity map, a space in front, spaces
written as U+2581), cut into symbols of one letter, and its adjacent symbol pairs are
put on an agenda ordered by the score of the piece they would make, ties by place. The
best pair is merged, the pairs it touches are put on the agenda, and pairs that have
changed since they were put there are passed over. A letter without a piece becomes its
UTF-8 bytes.

Two neighbours that stand side by side in no piece are never merged across, which is read
off the vocabulary: in particular no piece holds a space mark or a sign behind a letter. Texts
are therefore cut before space marks, after words and around letters of one-letter pieces, and a
chunk not met before is cut at its other such places; the parts' merges cannot meet, so parts
and chunks that come again are not merged again. If a vocabulary has a piece across a space
mark, whole texts are one chunk.

In every Arrow batch the sentencepiece library encodes all parts that are new to it, in one
call, and the ids are compared; ``encode`` can also have it encode every whole text.
"""
from __future__ import annotations

import gc
import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heapify, heappop, heappush
from operator import add
from struct import pack

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylake.llm.bpe_trie import slices
from paylake.llm.common import ship

MARK = "▁"            # fixed value: how the vocabulary writes a space
CACHE_BYTES = 160_000_000  # of parts and chunks remembered by a worker, twice at most
SLICE_CHARS = 1_000_000    # characters encoded and compared at once
PART_COST = 400            # bytes of a remembered part besides its letters and ids
SHORT = 48                 # letters of a part whose agenda is a plain list
NEVER = float("inf")       # cost of a pair that is no piece


@dataclass(frozen=True)
class Pieces:
    """A merge-type vocabulary: what a task needs of the model file."""
    content: bytes                  # the model file, for the library
    ids: dict[str, int]             # pieces that merges and letters can reach
    cost: dict[str, float]          # less the score: the least is merged first
    beside: set[str]                # pairs of letters that stand side by side in a piece
    text: list[str | int | None]    # by id: the piece with spaces, a byte, or None for a mark without text
    byte: list[int]                 # ids of the 256 bytes
    begin: int
    end: int

    @staticmethod
    def read(path: str) -> Pieces:
        from sentencepiece import sentencepiece_model_pb2 as pb
        with open(path, "rb") as f:
            content = f.read()
        m = pb.ModelProto.FromString(content)
        norm, train = m.normalizer_spec, m.trainer_spec
        if (train.model_type != pb.TrainerSpec.BPE or not train.byte_fallback or train.treat_whitespace_as_suffix
                or norm.precompiled_charsmap or norm.remove_extra_whitespaces
                or not norm.add_dummy_prefix or not norm.escape_whitespaces):
            raise ValueError("a merge-type vocabulary with byte pieces, no letter map and a space in front is needed")
        kind = pb.ModelProto.SentencePiece
        if any(p.type in (kind.USER_DEFINED, kind.UNUSED) for p in m.pieces):
            raise ValueError("vocabularies with user-defined or unused pieces are not supported")
        named = {p.piece: i for i, p in enumerate(m.pieces)}
        plain = [(i, p) for i, p in enumerate(m.pieces) if p.type == kind.NORMAL]
        text: list[str | int | None] = [None] * len(m.pieces)
        for i, p in plain:
            text[i] = p.piece.replace(MARK, " ")
        byte = [named[f"<0x{b:02X}>"] for b in range(256)]
        for b, i in enumerate(byte):
            text[i] = b
        beside = {p.piece[i:i + 2] for _, p in plain for i in range(len(p.piece) - 1)}
        return Pieces(content, {p.piece: i for i, p in plain}, {p.piece: -p.score for _, p in plain}, beside, text, byte, named[train.bos_piece or "<s>"], named[train.eos_piece or "</s>"])


class Encoder:
    """Encodes texts. What it remembers has two generations: when the younger one reaches
    ``CACHE_BYTES`` it becomes the older one, and what that held is forgotten."""

    def __init__(self, pieces: Pieces):
        self.v = pieces
        if any(pair[1] == MARK != pair[0] for pair in pieces.beside):
            self.cut = None
        else:
            joined = set().union(*pieces.beside)
            alone = re.escape("".join(chr(c) for c in range(128) if chr(c) not in joined))
            # letters that no sign follows in a piece
            odd, found = "", None
            while found != "":
                word = f"[^\\W\\d_{re.escape(odd)}]"
                found = "".join({p[0] for p in pieces.beside if re.match(word, p[0]) and not re.match(word, p[1])})
                odd += found
            sign = f"(?:(?!{word})[^{MARK}{alone}])"
            self.cut = re.compile(f"{MARK}*{word}+|{MARK}*{sign}+{word}*|{MARK}+" + (f"|[{alone}]" if alone else ""))
        self.ids: dict[str, bytes] = {}
        self.shown: dict[str, str] = {}
        self.older: tuple[dict[str, bytes], dict[str, str]] = ({}, {})
        self.bytes = 0
        self.code = {p: pack("<I", i) for p, i in pieces.ids.items()}           # ids and text of pieces, for joining
        self.said = {p: pieces.text[i] for p, i in pieces.ids.items()}
        self.unlike: set[str] = set()   # parts for which the library gave other ids

    def chunks(self, text: str) -> list[str]:
        """The normalised text in chunks (an empty text has none)."""
        if not text:
            return []
        text = MARK + text.replace(" ", MARK)
        return self.cut.findall(text) if self.cut else [text]

    def parts(self, chunk: str) -> list[str]:
        """The chunk cut between neighbours that no piece holds side by side."""
        beside, out, at = self.v.beside, [], 0
        for i, pair in enumerate(map(add, chunk, chunk[1:]), 1):
            if pair not in beside:
                out.append(chunk[at:i])
                at = i
        out.append(chunk[at:])
        return out

    def merge(self, part: str) -> list[int]:
        """Ids of one part by the agenda, which is a list in place for short parts and a heap
        for long ones. The order is the same: least cost, then leftmost."""
        out, ids, byte = [], self.v.ids, self.v.byte
        for s in self._merge_short(part) if len(part) <= SHORT else self._merge_long(part):
            token = ids.get(s)
            if token is None:
                out.extend(map(byte.__getitem__, s.encode()))
            else:
                out.append(token)
        return out

    def _learn(self, parts: list[str]) -> None:
        """Encode and decode new parts."""
        code, said, short, ids, shown, size = self.code, self.said, self._merge_short, self.ids, self.shown, 0
        for part in parts:
            symbols = short(part) if len(part) <= SHORT else self._merge_long(part)
            try:
                ids[part] = packed = b"".join([code[s] for s in symbols])
                shown[part] = "".join([said[s] for s in symbols])
            except KeyError:    # a letter without a piece: its bytes
                found = self.merge(part)
                ids[part] = packed = pack(f"<{len(found)}I", *found)
                shown[part] = self.show(found)
            size += PART_COST + 2 * len(part) + len(packed)
        self.bytes += size

    def _merge_short(self, part: str) -> list[str]:
        cost, symbols = self.v.cost.get, list(part)
        agenda = [cost(pair, NEVER) for pair in map(add, part, part[1:])]   # by place: cost of the pair that begins there
        while agenda:
            least = min(agenda)
            if least == NEVER:
                break
            i = agenda.index(least)
            s = symbols[i] + symbols.pop(i + 1)
            symbols[i] = s
            del agenda[i]
            if i:
                agenda[i - 1] = cost(symbols[i - 1] + s, NEVER)
            if i < len(agenda):
                agenda[i] = cost(s + symbols[i + 1], NEVER)
        return symbols

    def _merge_long(self, part: str) -> list[str]:
        n, cost = len(part), self.v.cost.get
        stop = [*range(1, n + 1), 0]            # where the symbol at a place ends; 0: merged away
        left = list(range(-1, n))               # the symbol before
        agenda = [(c, i, i + 2) for i, c in enumerate(map(cost, map(add, part, part[1:]))) if c is not None]
        heapify(agenda)
        while agenda:
            _, a, end = heappop(agenda)
            b = stop[a]
            if not b or stop[b] != end:         # one of the two has changed since
                continue
            stop[a], stop[b], left[end] = end, 0, a
            c = cost(part[a:stop[end]]) if end < n else None
            if c is not None:
                heappush(agenda, (c, a, stop[end]))
            before = left[a]
            c = cost(part[before:end]) if before >= 0 else None
            if c is not None:
                heappush(agenda, (c, before, end))
        out, at = [], 0
        while at < n:
            out.append(part[at:stop[at]])
            at = stop[at]
        return out

    def show(self, ids: list[int]) -> str:
        """The text of ids: pieces with their marks as spaces, runs of bytes as UTF-8;
        marks without text give nothing."""
        found = [self.v.text[i] for i in ids]
        try:
            return "".join(found)
        except TypeError:       # there are bytes or marks without text
            pass
        out, run = [], bytearray()
        for t in [*found, ""]:
            if isinstance(t, int):
                run.append(t)
            elif t is not None:
                out += [run.decode("utf-8", "replace"), t]
                run.clear()
        return "".join(out)

    def decode(self, ids: list[int]) -> str:
        """The text of a whole sequence: the space in front is taken off."""
        return self.show(ids).removeprefix(" ")

    def encode(self, texts: list[str], library: Library | None = None) -> list[tuple[bytes, str, bool]]:
        """(ids as little-endian 32-bit integers, with begin and end; decoded text; whether the
        library gives the same ids for all its parts) of each text. Without ``library`` nothing is compared."""
        if self.bytes > CACHE_BYTES:
            self.older = self.ids, self.shown
            self.ids, self.shown, self.bytes = {}, {}, 0
        chunks = [self.chunks(t) for t in texts]
        cut = {c: self.parts(c) for c in self._recall(set().union(*chunks).difference(self.ids))}
        new = list(self._recall(set().union(*cut.values()).difference(self.ids)))
        self._learn(new)
        if library is not None:
            self.unlike.update(library.differing(new, self.ids))
        ids, shown = self.ids, self.shown
        for chunk, parts in cut.items():
            if len(parts) > 1:
                self._keep(chunk, b"".join([ids[p] for p in parts]), "".join([shown[p] for p in parts]))
        begin, end = pack("<I", self.v.begin), pack("<I", self.v.end)
        # a letter's bytes are all in one chunk, so chunks are shown one by one
        return [(b"".join([begin, *map(self.ids.__getitem__, c), end]),
                 "".join(map(self.shown.__getitem__, c)).removeprefix(" "),
                 not self.unlike or self.unlike.isdisjoint(p for x in c for p in self.parts(x))) for c in chunks]

    def _recall(self, new: set[str]) -> set[str]:
        """Those of ``new`` that are not remembered; parts of the older generation move to the younger."""
        old_ids, old_shown = self.older
        again = new.intersection(old_ids)
        for part in again:
            self._keep(part, old_ids[part], old_shown[part])
        return new - again

    def _keep(self, part: str, ids: bytes, shown: str) -> None:
        self.ids[part], self.shown[part] = ids, shown
        self.bytes += PART_COST + 2 * len(part) + len(ids)


class Library:
    """The sentencepiece library over the same model, to compare with."""

    def __init__(self, pieces: Pieces):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_proto=pieces.content)
        # a letter without a piece that stands beside no other, so it never merges: put in front of a
        # part, it keeps the space that the library adds away from it
        self.wall = next((c for c in map(chr, range(1, 32)) if c not in pieces.ids and not any(c in p for p in pieces.beside)), "")
        self.front = len(self.model.encode(self.wall)) if self.wall else 0

    def encode(self, texts: list[str]) -> list[bytes]:
        found = self.model.encode(texts, add_bos=True, add_eos=True, num_threads=1)
        return [np.array(ids, "<u4").tobytes() for ids in found]

    def differing(self, parts: list[str], ids: dict[str, bytes]) -> list[str]:
        """Those of ``parts`` for which the library gives other ids (all, if they cannot be told apart
        from the space in front)."""
        found = self.model.encode([self.wall + p.replace(MARK, " ") for p in parts], num_threads=1)
        n = self.front
        return [p for p, got in zip(parts, found) if pack(f"<{len(got) - n}I", *got[n:]) != ids[p]]


_workers: dict[bytes, tuple[Encoder, Library]] = {}


def worker_for(pieces: Pieces) -> tuple[Encoder, Library]:
    """Encoder and library of this worker process, so that later tasks find their parts known."""
    key = hashlib.sha256(pieces.content).digest()
    if key not in _workers:
        gc.disable()  # the tables hold no cycles, and scanning them again and again is slow
        _workers.clear()
        _workers[key] = Encoder(pieces), Library(pieces)
    return _workers[key]


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def encode(docs: DataFrame, path: str | None = None, key: str = "doc_id", text: str = "text",
           ids: bool = True, whole_texts: bool = False) -> DataFrame:
    """Encode every whole text with begin and end: (key, n_tokens, token_ids array, decoded,
    ids_sha256, decoded_sha256, as_library).

    ``as_library`` says whether the sentencepiece library gives the same ids for all parts of
    the text and, with ``whole_texts``, for the whole text too. Null text counts as empty: two ids, decoded to the empty text. A null key
    stays null; repeated rows give repeated rows; an empty table gives an empty result;
    other columns of ``docs`` are not read, so their names cannot clash. A very long text
    is one slice of its own. ``ids=False`` leaves ``token_ids`` and ``decoded`` out.
    """
    pieces = ship(docs.sparkSession).broadcast(Pieces.read(path or default_path()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, library = worker_for(pieces.value)
        for batch in batches:
            at = 0
            for texts in slices((t.as_py() or "" for t in batch.column(1)), SLICE_CHARS):
                got = encoder.encode(texts, library)
                same = [g[2] for g in got]
                if whole_texts:
                    same = [ok and g[0] == ids_ for ok, g, ids_ in zip(same, got, library.encode(texts))]
                sizes = [len(g[0]) // 4 for g in got]
                cols = [batch.column(0).slice(at, len(texts)), pa.array(sizes, pa.int64())]
                if ids:
                    flat = np.frombuffer(b"".join(g[0] for g in got), "<u4").astype(np.int32)
                    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                    cols += [pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)), pa.array([g[1] for g in got], pa.string())]
                cols += [pa.array([hashlib.sha256(g[0]).hexdigest() for g in got], pa.string()),
                         pa.array([hashlib.sha256(g[1].encode()).hexdigest() for g in got], pa.string()),
                         pa.array(same, pa.bool_())]
                at += len(texts)
                yield pa.RecordBatch.from_arrays(cols, names)

    kind = docs.select(F.col(f"`{key}`")).schema[0].dataType.simpleString()
    out = [("k", kind), ("n_tokens", "long"), *([("token_ids", "array<int>"), ("decoded", "string")] if ids else []),
           ("ids_sha256", "string"), ("decoded_sha256", "string"), ("as_library", "boolean")]
    names = [n for n, _ in out]
    df = docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t"))
    return df.mapInArrow(run, ", ".join(f"{n} {t}" for n, t in out)).withColumnRenamed("k", key)
