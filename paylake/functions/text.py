"""Text expressions with warehouse (Postgres-style) semantics."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from paylake import schemas as S

# A word is a run of letters/digits; everything else separates words.
_WORD_OR_GAP = r"[\p{L}\p{N}]+|[^\p{L}\p{N}]+"


def pg_initcap(c: Column) -> Column:
    """INITCAP that breaks words at every non-alphanumeric character.

    Spark's ``initcap`` only breaks at spaces (``O'brien-smith``); this splits
    the lower-cased text into word and gap runs and upper-cases the first
    character of each run (a no-op on gaps).
    """
    runs = F.regexp_extract_all(F.lower(c), F.lit(_WORD_OR_GAP), F.lit(0))
    return F.array_join(F.transform(runs, lambda w: F.concat(F.upper(F.substring(w, 1, 1)),
                                                             F.substring(w, 2, 1 << 30))), "")


def clean_code(c: Column, default: str) -> Column:
    """``COALESCE(UPPER(TRIM(c)), default)`` -- a blank stays blank."""
    return F.coalesce(F.upper(F.trim(c)), F.lit(default))


def surrogate_key(*cols: Column) -> Column:
    """md5 of the ``-``-joined text of the columns, NULL as a fixed token."""
    parts = [F.coalesce(c.cast("string"), F.lit(S.SURROGATE_NULL)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


def month_name_padded(d: Column) -> Column:
    """``TO_CHAR(d, 'Month')``: full month name blank-padded to 9."""
    return F.rpad(F.date_format(d, "MMMM"), 9, " ")


def day_name_padded(d: Column) -> Column:
    """``TO_CHAR(d, 'Day')``: full day name blank-padded to 9."""
    return F.rpad(F.date_format(d, "EEEE"), 9, " ")
