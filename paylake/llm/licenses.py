"""License scans: MinHash bands over overlapping windows, verified by shingle containment.

A template of L words belongs to the window class of the least length w >= 2.5 L (16
words, doubled until it fits); texts are cut into windows of w words every w / 2, so a template with some words put in
between still lies inside one window. A window that holds 0.8 of a template's
five-word shingles has a least resemblance J to it; one-row bands, ln(MISS) / ln(1 - J)
of them, make the chance that no band agrees less than MISS. Windows without a single
template shingle cannot match and are left out before hashing.

A template shorter than a shingle is one shingle of its whole word sequence; its windows
are all runs of as many words, so it is found word for word wherever it stands.

Only built-in functions run: the template table is a parameter of the job and the only
thing broadcast.
"""
from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylake.llm.common import ascii_lower

SHINGLE = 5
CONTAINED = 0.8
MISS = 1e-6
STRETCH = 2.5
LEAST_WINDOW = 16

# fixed values: public wordings of licence notices
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0-header", "you may not use this file except in compliance with the License. "
                          "You may obtain a copy of the License at"),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted "
            "provided that the following conditions are met"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("GPL-3.0", "licensed under the GNU General Public License, version 3"),
    ("GPL-header", "This program is free software: you can redistribute it and/or modify it under the terms of the "
                   "GNU General Public License as published by the Free Software Foundation"),
    ("MIT", "Released under the MIT License"),
    ("MIT-grant", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                  "associated documentation files, to deal in the Software without restriction"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("Proprietary", "All rights reserved. Unauthorized copying of this file, via any medium is strictly prohibited"),
)
# notices of less than five words
SHORT_TEMPLATES = (
    ("All-rights-reserved", "All rights reserved"),
)


def template_words(text: str) -> list[str]:
    return [w for w in re.split(r"[^a-z0-9]+", text.lower()) if w]


@dataclass(frozen=True)
class Template:
    name: str
    words: tuple[str, ...]

    @property
    def window(self) -> int:
        if self.short:
            return len(self.words)
        w = LEAST_WINDOW
        while w < STRETCH * len(self.words):
            w *= 2
        return w

    @property
    def short(self) -> bool:
        return len(self.words) < SHINGLE

    @property
    def bands(self) -> int:
        shingles = len(set(zip(*[self.words[i:] for i in range(SHINGLE)])))
        need = math.ceil(CONTAINED * shingles)
        least = need / (self.window - SHINGLE + 1 + shingles - need)
        return math.ceil(math.log(MISS) / math.log(1 - least)) if least < 1 else 1


def templates(pairs: tuple[tuple[str, str], ...] = TEMPLATES) -> list[Template]:
    """The templates that have a word."""
    made = [Template(n, tuple(template_words(t))) for n, t in pairs]
    return [t for t in made if t.words]


def word_hashes(text: Column) -> Column:
    words = F.split(ascii_lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.transform(F.array_remove(words, ""), lambda w: F.xxhash64(w))


def shingles(hashes: Column, size: int = SHINGLE) -> Column:
    n = F.size(hashes)
    return F.when(n >= size, F.transform(F.sequence(F.lit(0), n - size), lambda i: F.xxhash64(
        *[F.get(hashes, i + j) for j in range(size)]))).otherwise(F.array().cast("array<bigint>"))


def bands(window: Column, number: int) -> Column:
    """One value per band: the hashed number and minimum of the window's shingles under it."""
    return F.transform(F.sequence(F.lit(1), F.lit(number)), lambda j: F.xxhash64(
        j, F.array_min(F.transform(window, lambda s: F.xxhash64(s, j)))))


def scan(docs: DataFrame, pairs: tuple[tuple[str, str], ...] = TEMPLATES, key: str = "doc_id",
         text: str = "text") -> DataFrame:
    """(key, license, containment, start_word, n_windows): one row per document and template that
    some window of it contains.

    ``containment`` is the best of its windows, ``start_word`` the word (from 0) at which the
    first of these begins, ``n_windows`` the number of matching windows. Null texts and
    texts shorter than the template match nothing; null keys are kept; repeated rows give repeated rows; an empty
    table gives an empty result; other columns are not read.
    """
    known = templates(pairs)
    df = docs.select(F.col(f"`{key}`").alias("k"), word_hashes(F.col(f"`{text}`")).alias("h"))
    df = df.select(F.monotonically_increasing_id().alias("rid"), "k", "h")
    parts = [find(df, some) for find, some in ((_contained, [t for t in known if not t.short]),
                                               (_verbatim, [t for t in known if t.short])) if some]
    if not parts:
        raise ValueError("no template has a word")
    hit = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    best = F.max(F.struct(F.col("c"), -F.col("at")))
    out = hit.groupBy("rid", "k", "license").agg(best.alias("x"), F.count_distinct("at").alias("n_windows"))
    return out.select(F.col("k").alias(key), "license", F.col("x.c").alias("containment"),
                      (-F.col("x").getField("col2") - 1).alias("start_word"), "n_windows")


def _verbatim(df: DataFrame, known: list[Template]) -> DataFrame:
    """(rid, k, license, at, c) of every run of words (hashes h) that is a template below a shingle's length."""
    spark = df.sparkSession
    table = spark.createDataFrame([(t.name, list(t.words), t.window) for t in known], "license string, words array<string>, w int")
    hashed = F.transform("words", lambda x: F.xxhash64(x))
    sizes = sorted({t.window for t in known})
    whole = F.coalesce(*[F.when(F.col("w") == n, F.get(shingles(hashed, n), F.lit(0))) for n in sizes])
    rows = table.select("license", "w", whole.alias("s")).collect()
    found = []
    for n in sizes:
        mine = F.array(*[F.lit(s) for s in sorted({r.s for r in rows if r.w == n})])
        found.append(F.filter(F.transform(shingles(F.col("h"), n), _run(n)), _among(mine)))
    index = spark.createDataFrame([(r.license, r.w, r.s) for r in rows], "license string, w int, s long")
    # one explode of all lengths: see the windows below
    at = df.select("rid", "k", F.explode(F.flatten(F.array(*found))).alias("v")).select("rid", "k", "v.w", "v.at", "v.s")
    return at.join(F.broadcast(index), ["s", "w"]).select("rid", "k", "license", "at", F.lit(1.0).alias("c"))


def _run(n: int):
    return lambda s, i: F.struct(F.lit(n).alias("w"), (i + 1).alias("at"), s.alias("s"))


def _among(values: Column):
    return lambda v: F.array_contains(values, v.getField("s"))


def _contained(df: DataFrame, known: list[Template]) -> DataFrame:
    """(rid, k, license, at, c) of every window of the texts (word hashes h) that contains a template of a shingle or more."""
    spark = df.sparkSession
    table = spark.createDataFrame(
        [(t.name, list(t.words), t.window, t.bands) for t in known], "license string, words array<string>, w int, m int")
    table = table.select("license", "w", "m", F.array_distinct(shingles(F.transform("words", lambda x: F.xxhash64(x)))).alias("ts"))
    # the template table's own digests are needed as literals; its rows are a parameter of the job
    rows = table.select("license", "w", "m", "ts", F.transform(F.sequence(F.lit(1), F.col("m")), lambda j: F.xxhash64(
        j, F.array_min(F.transform("ts", lambda s: F.xxhash64(s, j))))).alias("bands")).collect()
    literal = lambda values: F.array(*[F.lit(v) for v in sorted(values)]).cast("array<bigint>")
    every = literal({s for r in rows for s in r.ts})
    df = df.select("rid", "k", shingles(F.col("h")).alias("s"))
    cut = []
    for w in sorted({r.w for r in rows}):
        mine = [r for r in rows if r.w == w]
        starts = F.sequence(F.lit(1), F.size("s"), F.lit(w // 2))
        cut.append(F.transform(starts, _window(w, max(r.m for r in mine))))
    # explode drops documents without any template shingle; a filter would be pushed into the
    # projections below and evaluate them again for every element
    df = df.select("rid", "k", F.explode(F.when(F.arrays_overlap("s", every), F.flatten(F.array(*cut)))).alias("v"))
    df = df.select("rid", "k", "v.w", "v.m", "v.at", "v.s").filter(F.arrays_overlap("s", every))
    values = literal({b for r in rows for b in r.bands})
    df = df.withColumn("b", F.array_distinct(F.array_intersect(bands(F.col("s"), F.col("m")), values)))
    df = df.select("rid", "k", "w", "at", "s", F.explode("b").alias("band"))
    index = spark.createDataFrame([(b, r.license, r.w, list(r.ts)) for r in rows for b in sorted(set(r.bands))],
                                  "band long, license string, w int, ts array<long>")
    hit = df.join(F.broadcast(index), ["band", "w"])
    share = F.size(F.array_intersect("s", "ts")) / F.size("ts")
    return hit.select("rid", "k", "license", "at", share.alias("c")).filter(F.col("c") >= CONTAINED)


def _window(w: int, m: int):
    return lambda at: F.struct(F.lit(w).alias("w"), F.lit(m).alias("m"), at.alias("at"),
                               F.slice("s", at, F.lit(w - SHINGLE + 1)).alias("s"))
