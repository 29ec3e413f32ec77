"""Document fingerprints: invertible Bloom lookup tables of paragraph digests.

A text's paragraphs are its lines, long ones cut every 160 code points; each distinct
one gives a 64-bit digest. The digests fall by their leading bits into groups of
about four, and every group is a small table of cells (count, xor of digests, xor
of checks) that each digest enters at three places. Two versions' tables subtract
cell by cell; peeling then takes out digests from cells that hold a single one until
all that differ are recovered. A table that does not peel is tried again with twice
the cells.

Everything is column expressions: no Python code runs on the executors, and a text's
tables never leave its row.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paylake.llm.common import settle

PIECE = 160          # code points of a paragraph at most
GROUP = 4            # digests of a group on average, at most
CELLS = 18           # cells of a group's table in the first attempt: three parts of six
TRIES = 4            # attempts, each with twice the cells; what is still stuck is compared directly
BUCKET = 256         # consecutive documents that find their successors together
CHECK = 977          # seed of the check hash; places use the attempt and part

Cells = "array<struct<c:int,k:bigint,h:bigint>>"


def digests(text: Column) -> Column:
    """Distinct paragraph digests of a text."""
    parts = F.regexp_extract_all(text, F.lit(f"[^\\n]{{1,{PIECE}}}"), F.lit(0))
    return F.array_distinct(F.transform(parts, lambda p: F.xxhash64(p)))


def _check(d: Column) -> Column:
    return F.xxhash64(d, F.lit(CHECK))


def _entries(ds: Column, cells: int) -> Column:
    """Each digest with its check and its three places in a table of ``cells``."""
    part = cells // 3
    place = lambda d, j: (F.pmod(F.xxhash64(d, F.lit(cells), F.lit(j)), F.lit(part)) + j * part).cast("int")
    return F.transform(ds, lambda d: F.struct(
        d.alias("d"), _check(d).alias("h"), place(d, 0).alias("x"), place(d, 1).alias("y"), place(d, 2).alias("z")))


def _cell(c: Column, k: Column, h: Column) -> Column:
    return F.struct(c.cast("int").alias("c"), k.cast("bigint").alias("k"), h.cast("bigint").alias("h"))


def _toggle(cells: Column, e: Column, sign: Column) -> Column:
    """The table with one digest more (sign 1) or less (-1)."""
    return F.transform(cells, lambda c, i: F.when(
        (i == e["x"]) | (i == e["y"]) | (i == e["z"]),
        _cell(c["c"] + sign, c["k"].bitwiseXOR(e["d"]), c["h"].bitwiseXOR(e["h"]))).otherwise(c))


def table(ds: Column, cells: int) -> Column:
    """The cells of a group of digests."""
    none = F.transform(F.sequence(F.lit(1), F.lit(cells)), lambda _: _cell(F.lit(0), F.lit(0), F.lit(0)))
    return F.aggregate(_entries(ds, cells), none, lambda t, e: _toggle(t, e, F.lit(1)))


def subtract(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: _cell(x["c"] - y["c"], x["k"].bitwiseXOR(y["k"]), x["h"].bitwiseXOR(y["h"])))


def peel(cells: Column, steps: Column, size: int) -> Column:
    """struct(ok, ours, theirs): the recovered digests of either side; not ok if cells remain.
    ``steps`` bounds the number of differing digests."""
    part = size // 3
    place = lambda d, j: (F.pmod(F.xxhash64(d, F.lit(size), F.lit(j)), F.lit(part)) + j * part).cast("int")
    longs = F.array().cast("array<bigint>")
    start = F.struct(cells.alias("t"), longs.alias("ours"), longs.alias("theirs"), F.lit(False).alias("done"))

    def step(s: Column, _: Column) -> Column:
        single = F.filter(s["t"], lambda c: ((c["c"] == 1) | (c["c"] == -1)) & (_check(c["k"]) == c["h"]))
        # the first single cell as an array of one (or none), so that it is found once
        after = F.transform(F.slice(single, 1, 1), lambda c: F.struct(
            _toggle(s["t"], F.struct(c["k"].alias("d"), c["h"].alias("h"), place(c["k"], 0).alias("x"),
                                     place(c["k"], 1).alias("y"), place(c["k"], 2).alias("z")), -c["c"]).alias("t"),
            F.when(c["c"] == 1, F.concat(s["ours"], F.array(c["k"]))).otherwise(s["ours"]).alias("ours"),
            F.when(c["c"] == -1, F.concat(s["theirs"], F.array(c["k"]))).otherwise(s["theirs"]).alias("theirs"),
            F.lit(False).alias("done")))
        stuck = F.struct(s["t"].alias("t"), s["ours"].alias("ours"), s["theirs"].alias("theirs"), F.lit(True).alias("done"))
        return F.when(s["done"], s).otherwise(F.coalesce(F.get(after, F.lit(0)), stuck))

    turns = F.when(steps > 0, F.sequence(F.lit(1), steps)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(turns, start, step, lambda s: F.struct(
        (~F.exists(s["t"], lambda c: (c["c"] != 0) | (c["k"] != 0) | (c["h"] != 0))).alias("ok"),
        s["ours"].alias("ours"), s["theirs"].alias("theirs")))


def _bits(n: Column) -> Column:
    """Leading bits that part n digests into groups of GROUP or fewer on average."""
    return F.when(n > GROUP, F.ceil(F.log2(n / F.lit(float(GROUP))))).otherwise(F.lit(0)).cast("int")


def _group(d: Column, bits: Column) -> Column:
    return F.when(bits > 0, F.call_function("shiftright", d, F.lit(64) - bits)).otherwise(F.lit(0).cast("bigint"))


def fingerprint(ds: Column) -> Column:
    """A short string of the whole table: number of digests, bits, and the xor of hashed cells.

    The entries are sorted by cell and folded once, so the cells need not be stored.
    """
    bits, part = _bits(F.size(ds)), CELLS // 3
    at = lambda d, j: F.struct(
        _group(d, bits).alias("g"),
        (F.pmod(F.xxhash64(d, F.lit(CELLS), F.lit(j)), F.lit(part)) + j * part).cast("int").alias("i"), d.alias("d"))
    entries = F.sort_array(F.flatten(F.transform(ds, lambda d: F.array(*[at(d, j) for j in range(3)]))))
    zero = F.lit(0).cast("bigint")
    start = F.struct(zero.alias("g"), F.lit(-1).alias("i"), F.lit(0).alias("c"), zero.alias("k"), zero.alias("h"),
                     zero.alias("p"), zero.alias("q"))

    def close(a: Column) -> tuple[Column, Column]:
        cell = (a["g"], a["i"], a["c"], a["k"], a["h"])
        return a["p"].bitwiseXOR(F.xxhash64(*cell)), a["q"].bitwiseXOR(F.xxhash64(F.lit(CHECK), *cell))

    def step(a: Column, e: Column) -> Column:
        p, q = close(a)
        same = (a["g"] == e["g"]) & (a["i"] == e["i"])
        return F.when(same, F.struct(
            a["g"].alias("g"), a["i"].alias("i"), (a["c"] + 1).alias("c"), a["k"].bitwiseXOR(e["d"]).alias("k"),
            a["h"].bitwiseXOR(_check(e["d"])).alias("h"), a["p"].alias("p"), a["q"].alias("q"))).otherwise(F.struct(
                e["g"].alias("g"), e["i"].alias("i"), F.lit(1).alias("c"), e["d"].alias("k"), _check(e["d"]).alias("h"),
                p.alias("p"), q.alias("q")))

    hexed = lambda x: F.lower(F.lpad(F.hex(x), 16, "0"))
    return F.concat_ws("-", F.size(ds).cast("string"), bits.cast("string"), F.aggregate(
        entries, start, step, lambda a: F.concat(*[hexed(x) for x in close(a)])))


def sketches(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The whole tables: (key, group, cells), one row per document and group of digests."""
    df = docs.select(F.col(f"`{key}`").alias("k"), digests(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("d"))
    df = df.select("k", _grouped(_tag("d", 0), _bits(F.size("d"))).alias("g"))
    df = df.select("k", F.explode("g").alias("g"))
    return df.select(F.col("k").alias(key), F.col("g.g").alias("group"),
                     table(F.transform("g.e", lambda e: e["d"]), CELLS).alias("cells"))


def _grouped(entries: Column, bits: Column) -> Column:
    """Entries (d, v) sorted and cut into groups: array of struct(g, e)."""
    return F.aggregate(
        F.sort_array(entries), F.array().cast("array<struct<g:bigint,e:array<struct<d:bigint,v:int>>>>"),
        lambda a, e: F.when(
            (F.size(a) > 0) & (F.element_at(a, -1)["g"] == _group(e["d"], bits)),
            F.concat(F.slice(a, F.lit(1), F.size(a) - 1), F.array(F.struct(
                F.element_at(a, -1)["g"].alias("g"), F.concat(F.element_at(a, -1)["e"], F.array(e)).alias("e")))))
        .otherwise(F.concat(a, F.array(F.struct(_group(e["d"], bits).alias("g"), F.array(e).alias("e"))))))


def _tag(ds: str, v: int) -> Column:
    return F.transform(ds, lambda d: F.struct(d.alias("d"), F.lit(v).alias("v")))


def _untag(entries: str, v: int) -> Column:
    return F.transform(F.filter(entries, lambda e: e["v"] == v), lambda e: e["d"])


def likeness(df: DataFrame, ours: str, others: list[str], keep: list[str]) -> DataFrame:
    """``df`` (one row each) reduced to ``keep`` with a column near_<name> for every digest
    array in ``others``: shared over all digests, from the recovered differences."""
    names = [ours, *others]
    most = F.greatest(F.lit(1), *[F.size(n) for n in names])
    tagged = F.concat(*[_tag(n, v) for v, n in enumerate(names)])
    df = df.select(*keep, *[F.size(n).alias(f"_n{v}") for v, n in enumerate(names)],
                   _bits(most).alias("_bits"), F.sort_array(tagged).alias("_e"))
    # where groups begin, in one pass over the sorted entries
    starts = F.filter(F.transform("_e", lambda e, i: F.when(
        (i == 0) | (_group(e["d"], F.col("_bits")) != _group(F.get("_e", i - 1)["d"], F.col("_bits"))), i + 1)),
        lambda i: i.isNotNull())
    df = df.withColumn("_starts", starts)
    df = df.select("*", F.posexplode_outer("_starts").alias("_j", "_at")).withColumn(
        "_to", F.coalesce(F.get("_starts", F.col("_j") + 1), F.size("_e") + 1))
    counts = [f"_n{v}" for v in range(len(names))]
    df = df.select(*keep, *counts, F.when(F.col("_at").isNotNull(), F.slice("_e", F.col("_at"), F.col("_to") - F.col("_at")))
                   .otherwise(F.array().cast("array<struct<d:bigint,v:int>>")).alias("_g"))
    df = df.select(*keep, *counts, *[_untag("_g", v).alias(f"_s{v}") for v in range(len(names))])
    for n in range(TRIES):
        size = CELLS << n
        open_ = [F.lit(True) if not n else F.coalesce(~F.col(f"_r{v}.ok"), F.lit(True)) for v in range(1, len(names))]
        some = open_[0]
        for o in open_[1:]:
            some = some | o
        lists = [f"_s{v}" for v in range(len(names))]
        done = [] if not n else [f"_r{v}" for v in range(1, len(names))]
        df = df.select(*keep, *counts, *lists, *done, F.when(some, table(F.col("_s0"), size)).alias("_t0"))
        found = []
        for v, o in zip(range(1, len(names)), open_):
            new = F.when(o, peel(subtract(F.col("_t0"), table(F.col(f"_s{v}"), size)),
                                 F.size("_s0") + F.size(f"_s{v}"), size))
            found.append((new if not n else F.coalesce(new, F.col(f"_r{v}"))).alias(f"_r{v}"))
        df = df.select(*keep, *counts, *lists, *found)
    diffs = [F.when(F.col(f"_r{v}.ok"), F.size(f"_r{v}.ours") + F.size(f"_r{v}.theirs")).otherwise(
        F.size(F.array_except("_s0", f"_s{v}")) + F.size(F.array_except(f"_s{v}", "_s0"))) for v in range(1, len(names))]
    df = df.select(*keep, *counts, *[d.cast("long").alias(f"_d{v}") for v, d in enumerate(diffs, 1)])
    df = df.groupBy(*keep, *counts).agg(*[F.sum(f"_d{v}").alias(f"_d{v}") for v in range(1, len(names))])
    near = [F.when(F.col("_n0") + F.col(f"_n{v}") > 0, (F.col("_n0") + F.col(f"_n{v}") - F.col(f"_d{v}")).cast("double")
                   / (F.col("_n0") + F.col(f"_n{v}") + F.col(f"_d{v}"))).otherwise(F.lit(1.0)).alias(f"near_{name}")
            for v, name in enumerate(others, 1)]
    return df.select(*keep, *near)


def with_next(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(z, b, rid, k, t, u): every document with the text of the next one by ascending key.

    Keys are dealt into equal ranges of about ``BUCKET``; only the first document of each
    range meets the last one of the range before, and only range numbers (one in
    ``BUCKET`` rows), again in ranges, are put in one order.
    """
    k, t = F.col(f"`{key}`"), F.coalesce(F.col(f"`{text}`"), F.lit(""))
    df = docs.select(k.alias("k"), t.alias("t"), F.xxhash64(t).alias("x"), k.isNotNull().alias("z"),
                     F.coalesce(k.cast("bigint"), F.xxhash64(t)).alias("o"))
    ids = docs.select(k.cast("bigint").alias("k")).agg(F.min("k").alias("a"), F.max("k").alias("b"), F.count("k").alias("n")).first()
    low, n = ids.a or 0, max(1, ids.n)
    width = max(BUCKET, -(-((ids.b or 0) - low + 1) * BUCKET // n))
    bucket = F.when(F.col("z"), F.floor((F.col("o") - low) / F.lit(width)) if width < 1 << 40
                    else F.floor(F.col("o") / F.lit(float(width)))).otherwise(F.shiftright("o", 48)).cast("bigint")
    df = df.withColumn("b", bucket)
    here = Window.partitionBy("z", "b").orderBy("o", "x")
    heads = settle(df.withColumn("r", F.row_number().over(here)).filter("r = 1").select("z", "b", F.col("t").alias("head")), "heads")
    after = settle(_successors(heads.select("z", "b"))
                   .join(heads.select(F.col("z").alias("z2"), F.col("b").alias("b2"), "head"), ["z2", "b2"])
                   .select("z", "b", "head"), "after")
    df = df.withColumn("lead", F.lead("t").over(here)).join(after, ["z", "b"])
    return df.select("z", "b", F.monotonically_increasing_id().alias("rid"), "k", "t", F.coalesce("lead", "head").alias("u"))


def _successors(keys: DataFrame) -> DataFrame:
    """(z, b, z2, b2): the next pair in order for every pair, the first after the last."""
    part = keys.withColumn("s", F.shiftright("b", 10))
    inside = Window.partitionBy("z", "s").orderBy("b")
    part = part.withColumn("b2", F.lead("b").over(inside))
    tops = part.groupBy("z", "s").agg(F.min("b").alias("first"))
    order = Window.partitionBy().orderBy("z", "s")  # one row per 2**10 ranges
    tops = tops.select("z", "s", F.lead(F.struct("z", "first")).over(order).alias("next"),
                       F.first(F.struct("z", "first")).over(order).alias("start"))
    joined = part.join(tops.select("z", "s", F.coalesce("next", "start").alias("next")), ["z", "s"])
    return joined.select("z", "b", F.when(F.col("b2").isNotNull(), F.col("z")).otherwise(F.col("next.z")).alias("z2"),
                         F.coalesce("b2", "next.first").alias("b2"))


def compare_edited(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next).

    The edited text is the text with its last floor(n_chars / 2) code points replaced by
    the first as many (or all) of the next document. Null text counts as empty; two
    empty texts are alike (1.0). Null keys come before all others, in order of their
    text's hash; rows of equal key are ordered by their text's hash, repeated rows are
    interchangeable. An only document is its own next; an empty table gives an empty
    result; other columns are not read.
    """
    df = with_next(docs, key, text)
    n = F.length("t")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("t", F.lit(1), n - half), F.substring("u", F.lit(1), half))
    df = df.select("z", "b", "rid", "k", n.cast("long").alias("n_chars"), edited.alias("v"), "t", "u")
    df = df.select("z", "b", "rid", "k", "n_chars", F.sha2(F.col("v").cast("binary"), 256).alias("edited_sha256"),
                   digests(F.col("t")).alias("_a"), digests(F.col("v")).alias("edited"), digests(F.col("u")).alias("next"))
    df = df.select("*", fingerprint(F.col("_a")).alias("fingerprint"), fingerprint(F.col("edited")).alias("edited_fingerprint"))
    keep = ["z", "b", "rid", "k", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint"]
    out = likeness(df, "_a", ["edited", "next"], keep)
    return out.select(F.col("k").alias(key), *keep[4:], "near_edited", "near_next")
