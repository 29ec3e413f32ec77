"""Quality rules: a threshold table compiled into Spark column expressions.

Each :class:`Rule` names a metric with a lower and an upper bound. The metrics
are built-in expressions over one row (no user function, no shuffle), so the
whole check is a projection in the scan stage at any size.
"""
from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylake.llm.common import words

# fixed values: frequent function words of English, French, German and Spanish
STOP_WORDS = (
    "the of and to a in is that for it as was with be by on are this or from at an "
    "le la les de des du et en un une que qui dans pour sur au est par avec "
    "der die das und den von mit ein eine zu ist nicht im auf dem auch "
    "el los las y que se del una por con para es no lo su al"
).split()
SYMBOLS = "#*$%&|<>"
WINDOW = 8


@dataclass(frozen=True)
class Rule:
    metric: str
    low: float | None = None
    high: float | None = None


# A document is kept when every metric lies within its bounds. The ratios are
# wide on purpose: prose in the four languages, tables and lists stay well inside.
RULES = (
    Rule("n_words", low=20),
    Rule("mean_word_chars", low=2.0, high=20.0),
    Rule("symbol_ratio", high=0.05),
    Rule("stop_word_ratio", low=0.02),
    Rule("dup_line_ratio", high=0.50),
    Rule("bullet_line_ratio", high=0.90),
    Rule("ellipsis_line_ratio", high=0.30),
    Rule("repeat_word_ratio", high=0.30),
)


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a.cast("double") / b).otherwise(F.lit(0.0))


def _paired(before: str, step: int) -> Column:
    """Element i hashed with element i + step, for every i that has one."""
    n = F.greatest(F.size(before) - step, F.lit(0))
    return F.transform(F.slice(before, F.lit(1), n), lambda x, i: F.xxhash64(x, F.get(F.col(before), i + step)))


def verdict(rules: tuple[Rule, ...]) -> Column:
    """The conjunction of all bounds as one boolean column."""
    tests = [F.col(f"_m.{r.metric}") >= F.lit(r.low) for r in rules if r.low is not None]
    tests += [F.col(f"_m.{r.metric}") <= F.lit(r.high) for r in rules if r.high is not None]
    return reduce(and_, tests, F.lit(True))


def measure(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with a struct column ``quality`` (counts, ratios, base_failed, kept).

    Null text counts as empty: no words, ``base_failed`` true, ``kept`` false.
    Ties do not arise; repeated rows are judged alike, one by one; an empty table
    gives an empty result. Working columns live in structs whose names start
    with ``_``, so other columns of ``docs`` pass through whatever their names.

    ``n_repeat_words`` counts the words inside an 8-word window that occurs twice
    or more. Windows are compared by 64-bit hashes within one text: the distinct
    count decides whether any repeats, and only then are the hashes sorted.
    """
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    df = docs.select(whole, body.alias("_t"))
    df = df.select("_row", "_t", words(F.col("_t")).alias("_w"),
                   F.filter(F.split("_t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("_l"))
    df = df.select("*", F.transform("_w", lambda x: F.xxhash64(x)).alias("_h"))
    # hashes of 2, 4 and 8 words in a row, each from two of the size before
    for name, before, step in (("_h2", "_h", 1), ("_h4", "_h2", 2), ("_win", "_h4", 4)):
        df = df.select("_row", "_t", "_w", "_l", _paired(before, step).alias(name))
    df = df.select("_row", "_t", "_w", "_l", F.when(
        F.size(F.array_distinct("_win")) < F.size("_win"),
        F.sort_array(F.transform("_win", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
        .otherwise(F.array().cast("array<struct<h:bigint,i:int>>")).alias("_s"))
    twice = F.filter(F.transform("_s", lambda x, j: F.when(
        (F.get(F.col("_s"), j - 1)["h"] == x["h"]) | (F.get(F.col("_s"), j + 1)["h"] == x["h"]), x["i"])),
        lambda i: i.isNotNull())
    covered = F.aggregate(
        F.sort_array(twice), F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda a, i: F.struct((i + WINDOW).alias("end"), (a["n"] + i + WINDOW - F.greatest(i, a["end"])).alias("n")),
        lambda a: a["n"].cast("long"))
    n_stop = F.size(F.filter("_w", lambda x: x.isin(STOP_WORDS)))
    df = df.select(
        "_row",
        F.size("_w").cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        F.regexp_count("_t", F.lit(f"[{SYMBOLS}]")).cast("long").alias("n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        covered.alias("n_repeat_words"),
        F.size("_l").alias("n_lines"),
        n_stop.alias("n_stop_words"),
        F.size(F.filter("_l", lambda x: F.ltrim(x).rlike(r"^(?:[-*•]|\d+[.)])\s"))).alias("n_bullet_lines"),
        F.size(F.filter("_l", lambda x: F.rtrim(x).rlike(r"(?:\.\.\.|…)$"))).alias("n_ellipsis_lines"))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_stop_words",
              "n_bullet_lines", "n_ellipsis_lines"]
    ratios = {
        "mean_word_chars": _ratio(F.col("word_chars"), F.col("n_words")),
        "symbol_ratio": _ratio(F.col("n_symbols"), F.col("word_chars")),
        "stop_word_ratio": _ratio(F.col("n_stop_words"), F.col("n_words")),
        "dup_line_ratio": _ratio(F.col("n_dup_lines"), F.col("n_lines")),
        "bullet_line_ratio": _ratio(F.col("n_bullet_lines"), F.col("n_lines")),
        "ellipsis_line_ratio": _ratio(F.col("n_ellipsis_lines"), F.col("n_lines")),
        "repeat_word_ratio": _ratio(F.col("n_repeat_words"), F.col("n_words")),
    }
    df = df.select("_row", F.struct(*counts, *[c.alias(k) for k, c in ratios.items()]).alias("_m"))
    failed = (F.col("_m.n_words") < 20) | (100 * F.col("_m.n_repeat_words") > 30 * F.col("_m.n_words"))
    out = F.struct("_m.*", failed.alias("base_failed"), (~failed & verdict(rules)).alias("kept"))
    return df.select("_row", out.alias("_q"))


def keep_good(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows that pass every rule, columns unchanged."""
    # explode drops the others; a filter would be pushed into the projections below and
    # evaluate them again for every element
    kept = measure(docs, text, rules).select(F.explode(F.when(F.col("_q.kept"), F.array("_row"))).alias("_row"))
    return kept.select("_row.*")
