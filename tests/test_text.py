"""Property tests of the text and dedup helpers against plain Python."""
import hypothesis.strategies as st
from hypothesis import given, settings, HealthCheck
from pyspark.sql import functions as F

from paylake.functions import latest_per_key, pg_initcap


def py_initcap(s):
    """Word = run of letters/digits; first char of each word upper, rest lower."""
    out, prev_alnum = [], False
    for ch in s.lower():
        out.append(ch.upper() if ch.isalnum() and not prev_alnum else ch)
        prev_alnum = ch.isalnum()
    return "".join(out)


TEXT = st.text(alphabet=st.sampled_from(list("abcXYZ019 -'_.éÉß")), max_size=12)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(TEXT, min_size=1, max_size=20))
def test_pg_initcap_matches_python(spark, words):
    df = spark.createDataFrame([(w,) for w in words], "s string")
    got = [r.c for r in df.select(pg_initcap(F.col("s")).alias("c")).collect()]
    assert got == [py_initcap(w) for w in words]


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 4), st.one_of(st.none(), st.integers(0, 3)), st.integers(0, 9)),
                min_size=1, max_size=40))
def test_latest_per_key_matches_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "k int, t int, v int")
    got = sorted(tuple(r) for r in latest_per_key(df, ["k"], [F.col("t").desc_nulls_first()]).collect())
    want = []
    for k in sorted({r[0] for r in rows}):
        grp = [r for r in rows if r[0] == k]
        # NULL t first, then larger t, then the tie-breaks descending (NULLs last)
        best = sorted(grp, key=lambda r: (r[1] is not None, -(r[1] or 0), -r[1] if r[1] is not None else 0,
                                          -r[2]))[0]
        want.append(best)
    assert got == sorted(want)
