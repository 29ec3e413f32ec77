"""Load state, even extracts, cast quarantine, settlements by day, late dimension rows, compiled checks."""
import os
import uuid

import pytest
from pyspark.sql import functions as F

from paylake import schemas as S
from paylake.operators import extract, incremental, quality
from paylake.operators.checks import Foreign, Plan, Rule, Unique
from paylake.plans.catalog import QUERIES, warehouse
from paylake.session import shared_dir
from paylake.sources import state

from conftest import SF_SMALL


def _base(spark):
    return shared_dir(spark, "t", uuid.uuid4().hex)


# load state

def _table(spark, lo, hi):
    return spark.range(lo, hi).selectExpr("id", "timestampadd(MINUTE, CAST(id AS INT), TIMESTAMP_NTZ '2026-01-01 00:00:00') AS at")


def _polled(spark, out, poll):
    path = f"{out}/table_name=t/poll={poll}"
    return sorted((r.id, r.op) for r in spark.read.parquet(path).collect())


def test_polls_go_on_where_the_last_ended(spark, monkeypatch):
    base = _base(spark)
    root, out, marks = base + "/state", base + "/raw", {"t": "at", "u": None}
    u = spark.range(3)
    assert state.poll(spark, {"t": _table(spark, 0, 5), "u": u}, marks, root, out) == 0
    assert state.poll(spark, {"t": _table(spark, 0, 8), "u": u}, marks, root, out) == 1
    assert _polled(spark, out, 0) == [(i, "r") for i in range(5)]
    assert _polled(spark, out, 1) == [(i, "c") for i in range(4, 8)]           # the last second is read again
    log = {(r.seq, r.table_name): (r.status, r.n_rows) for r in state.entries(spark, root).collect()}
    assert log == {(0, "t"): ("completed", 5), (0, "u"): ("completed", 3), (1, "t"): ("watermark", 4)}
    with monkeypatch.context() as m:                                            # dies after the extract, before its entry
        m.setattr(state, "append", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            state.poll(spark, {"t": _table(spark, 0, 9), "u": u}, marks, root, out)
    assert state.poll(spark, {"t": _table(spark, 0, 10), "u": u}, marks, root, out) == 2
    assert _polled(spark, out, 2) == [(i, "c") for i in range(7, 10)]
    before = sorted(map(str, state.latest(spark, root).collect()))
    state.compact(spark, root)
    assert sorted(map(str, state.latest(spark, root).collect())) == before
    assert state.entries(spark, root).count() == 2 and state.next_seq(spark, root) == 3
    state.reset(spark, root, ["t"])
    assert {r.table_name: r.status for r in state.latest(spark, root).collect()} == {"t": "reset", "u": "completed"}
    assert state.poll(spark, {"t": _table(spark, 0, 10), "u": u}, marks, root, out) == 4
    assert _polled(spark, out, 4) == [(i, "r") for i in range(10)]
    state.compact(spark, root)
    state.compact(spark, root)
    assert {(r.table_name, r.status, r.seq) for r in state.latest(spark, root).collect()} == {("t", "completed", 4), ("u", "completed", 0)}


# extracts

def test_ranges_are_even_whatever_the_keys(spark):
    skewed = spark.range(20_000).select(F.when(F.col("id") < 19_000, F.col("id")).otherwise(F.col("id") * 10**9).alias("k"))
    skewed = skewed.unionByName(spark.createDataFrame([(10**17,), (None,), (None,)], "k bigint"))
    points = extract.split_points(skewed, "k", 8)
    sizes = [skewed.filter(p).count() for p in extract.range_predicates("k", points)]
    assert sum(sizes) == 20_003 and sizes[-1] == 2 and max(sizes[:-1]) <= 2 * sorted(sizes[:-1])[3] and len(sizes) == 9
    by = {r.key_range: r["count"] for r in extract.by_ranges(skewed, "k", 8).groupBy("key_range").count().collect()}
    assert [by[i] for i in range(8)] == sizes[:-1] and by[-1] == 2
    one = spark.createDataFrame([(5,)] * 10, "k bigint")
    assert [one.filter(p).count() for p in extract.range_predicates("k", extract.split_points(one, "k", 4))] == [10, 0, 0]
    assert extract.by_ranges(one.limit(0), "k", 4).count() == 0


def test_cast_split(spark):
    schema = S._s(*[(n, S.RAW_SCHEMAS["transactions"][n].dataType) for n in ("txn_id", "amount", "initiated_at", "settled_at", "fee")])
    rows = [("1", "2.50", "2026-01-01 10:00:00", None, "x"), ("2", "two", "soon", "2026-01-03", "y"), (None, None, None, "2026-02-30", None)]
    good, bad = extract.cast_split(spark.createDataFrame(rows, "txn_id string, amount string, initiated_at string, settled_at string, note string"), schema)
    assert good.schema == schema and [(r.txn_id, str(r.amount), r.fee) for r in good.collect()] == [(1, "2.50", None)]
    got = {r.error_msg: r.value for r in bad.collect()}
    assert set(got) == {"bad_cast:amount,initiated_at", "bad_cast:settled_at"} and '"note":"y"' in got["bad_cast:amount,initiated_at"]


def test_files_of_different_types_are_one_table(spark):
    base = _base(spark)
    schema = S._s(("id", S.RAW_SCHEMAS["transactions"]["txn_id"].dataType), ("at", S.TS), ("note", S.RAW_SCHEMAS["clients"]["city"].dataType))
    frames = [spark.createDataFrame([(1, "2026-01-01T10:00:00")], "id long, at string"), spark.createDataFrame([(2.0, None), (None, None)], "id double, at string"),
              spark.createDataFrame([(2.5, "2026-01-01T10:00:00", "x")], "id double, at string, note string")]
    for i, df in enumerate(frames):
        df.coalesce(1).write.mode("append").parquet(f"{base}/day={min(i, 1)}")     # the second folder holds two shapes
    frames[0].coalesce(1).write.mode("append").parquet(f"{base}/day=1")            # and a third that cannot be merged
    good, bad = extract.read_reconciled(spark, [base + "/day=0", base + "/day=1"], schema)
    assert good.schema == schema and sorted((r.id or 0, r.at is None, r.note) for r in good.collect()) == [
        (0, True, None), (1, False, None), (1, False, None), (2, True, None)]
    assert [r.error_msg for r in bad.collect()] == ["bad_cast:id"]


# settlements

def test_late_transactions_change_their_days_only(spark):
    base = _base(spark)
    fields = "txn_id bigint, merchant_id bigint, status_id int, amount decimal(14,2), fee decimal(10,2), currency string, initiated_at timestamp_ntz, created_at timestamp_ntz"

    def txns(*rows):
        return spark.createDataFrame(rows, "txn_id int, m int, st int, a int, c string, day int, v int").selectExpr(
            "CAST(txn_id AS BIGINT) txn_id", "CAST(m AS BIGINT) merchant_id", "st status_id", "CAST(a AS DECIMAL(14,2)) amount",
            "CAST(1 AS DECIMAL(10,2)) fee", "c currency", "timestampadd(DAY, day, TIMESTAMP_NTZ '2026-01-01 08:00:00') initiated_at",
            "timestampadd(HOUR, v, TIMESTAMP_NTZ '2026-03-01 00:00:00') created_at")

    statuses = spark.createDataFrame(S.TRANSACTION_STATUSES, "status_id int, code string, label string")
    first = txns((1, 7, 1, 100, "EUR", 0, 0), (2, 7, 1, 50, "USD", 0, 0), (3, 7, 6, 10, "USD", 1, 0), (4, 8, 1, 5, "USD", 2, 0))
    assert first.columns == [f.split(" ")[0] for f in fields.split(", ")]
    assert len(incremental.settle(first, first, statuses, base + "/s")) == 3
    rows = lambda: {(r.merchant_id, r.batch_date.day, r.currency): (r.txn_count, int(r.gross_amount))
                    for r in incremental.read_settlements(spark, base + "/s").collect()}
    assert rows() == {(7, 1, "EUR"): (1, 100), (7, 1, "USD"): (1, 50), (7, 2, "USD"): (1, 10), (8, 3, "USD"): (1, 5)}
    path = (base + "/s").replace("file:", "")
    kept = {f: os.path.getmtime(f"{path}/batch_date=2026-01-01/{f}") for f in os.listdir(f"{path}/batch_date=2026-01-01")}
    new = txns((3, 7, 6, 10, "USD", 4, 9), (5, 8, 1, 6, "USD", 2, 9))           # one moves to another day, one is late
    days = incremental.settle(first.unionByName(new), new, statuses, base + "/s")
    assert [d.day for d in days] == [2, 3, 5]
    assert rows() == {(7, 1, "EUR"): (1, 100), (7, 1, "USD"): (1, 50), (7, 5, "USD"): (1, 10), (8, 3, "USD"): (2, 11)}
    assert {f: os.path.getmtime(f"{path}/batch_date=2026-01-01/{f}") for f in os.listdir(f"{path}/batch_date=2026-01-01")} == kept
    assert incremental.settle(first, first.limit(0), statuses, base + "/s") == []


def test_late_merchants_take_their_facts(spark):
    base = _base(spark)
    fact = spark.createDataFrame([(1, 10, 7, 5, 1), (2, 10, 9, 6, 2), (3, -1, -1, 7, 2), (4, 99, 7, 8, 3)],
                                 "transaction_id long, client_id long, merchant_id long, amount int, day int").selectExpr(
        "transaction_id", "client_id", "merchant_id", "amount", "'USD' AS currency", "date_add(DATE '2026-01-01', day) AS date_key")
    ids = lambda name, *v: spark.createDataFrame([(x,) for x in v], f"{name} long")
    clients = spark.createDataFrame([(10, 3)], "client_id long, country_id int")
    place = spark.createDataFrame([(3, "L3")], "country_id int, location_key string")
    dates = fact.select("date_key").distinct()
    dims = {"dim_clients": ids("client_id", -1, 10), "dim_merchants": ids("merchant_id", -1, 7)}
    incremental.write_star(incremental.star_keys(fact, dims, clients, place, dates), base + "/star")
    got = lambda: {r.transaction_id: (r.client_key, r.merchant_key, r.location_key)
                   for r in spark.read.parquet(base + "/star").collect()}
    want = {1: (10, 7, "L3"), 2: (10, -1, "L3"), 3: (-1, -1, "unknown"), 4: (-1, 7, "unknown")}
    assert got() == want
    assert incremental.rekey(spark, base + "/star", dims, clients, place, dates) == []
    dims["dim_merchants"] = ids("merchant_id", -1, 7, 9, 9)
    days = incremental.rekey(spark, base + "/star", dims, clients, place, dates)
    assert [d.day for d in days] == [3] and got() == want | {2: (10, 9, "L3")}


# checks

def test_compiled_checks_by_hand(spark):
    kids = spark.createDataFrame([(1, "a", 5), (1, "a", 6), (2, None, None), (3, "a|b", 5), (3, "a", 99)], "id int, k string, p int")
    parents = spark.createDataFrame([(5,), (6,), (6,), (None,)], "p int")
    checks = [Unique("kids", ("id", "k")), Unique("kids", ("id",)), Unique("parents", ("p",)), Foreign("kids", "p", "parents", "p"),
              Foreign("kids", "id", "parents", "p"), Rule("low", "kids", "p", F.col("p") < 6), Rule("never", "kids", "p", F.col("p") < 0)]
    plan = Plan(checks, {"kids": kids, "parents": parents})
    got = {(r.check_name, r.model, r.column_name): r.failures for r in plan.report().collect()}
    assert got == {("unique", "kids", "id,k"): 1, ("unique", "kids", "id"): 2, ("unique", "parents", "p"): 1, ("relationships", "kids", "p"): 1,
                   ("relationships", "kids", "id"): 5, ("low", "kids", "p"): 2, ("never", "kids", "p"): 0}
    dups = {(r.model, r.column_name, r.key_value, r.occurrences) for r in plan.duplicates().collect()}
    assert dups == {("kids", "id,k", "1|a", 2), ("kids", "id", "1", 2), ("kids", "id", "3", 2), ("parents", "p", "6", 2)}
    assert {(r.child_column, r.orphans) for r in plan.orphans().collect()} == {("p", 1), ("id", 5)}
    empty = Plan(checks, {"kids": kids.limit(0), "parents": parents.limit(0)})
    assert {r.failures for r in empty.report().collect()} == {0} and empty.duplicates().count() == 0


@pytest.mark.parametrize("key", ["dq_report", "dq_unique", "fk_orphans", "dq_not_null"])
def test_reports_scan_the_fact_once(spark, key):
    df = QUERIES[key](spark, SF_SMALL)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    # the joins that make the fact ran once, when it was pinned
    assert "l_orderkey" not in plan


def test_report_has_every_check_once(spark):
    w = warehouse(spark, SF_SMALL)
    rows = quality.dq_report(w, relationships=True).collect()
    assert len(rows) == len({(r.check_name, r.model, r.column_name) for r in rows}) == 2 * 5 + 2 + len(quality.SOURCE_UNIQUE) + 6 + len(S.FOREIGN_KEYS)
