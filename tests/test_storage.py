"""Exactly-once behaviour of the landing stream and the ledger load."""
import os
import uuid

import pytest
from pyspark.sql import functions as F

from paylake import schemas as S
from paylake.operators import ingest
from paylake.plans.catalog import warehouse
from paylake.plans.queries_ops import _corrupted
from paylake.session import shared_dir
from paylake.sources import commits, raw_zone
from paylake.streaming import dedup, landing

from conftest import SF_SMALL


def test_landing_restart_adds_nothing(spark):
    base = shared_dir(spark, "t", uuid.uuid4().hex)
    landing.publish(_corrupted(warehouse(spark, SF_SMALL)), base + "/in")
    schema = S.RAW_SCHEMAS["transactions"]
    for _ in range(2):   # second run on the same checkpoint finds no new input
        landing.start_landing(spark, base + "/in", base + "/raw", base + "/dlq", base + "/ckpt",
                              {"transactions": schema}).awaitTermination()
    landed = spark.read.parquet(base + "/raw").count()
    dlq = spark.read.parquet(base + "/dlq").count()
    total = spark.read.parquet(base + "/in").count()
    assert landed + dlq == total and dlq > 0


RUN = "2026-01-01 01:00:00"


def _zone(spark):
    base = shared_dir(spark, "t", uuid.uuid4().hex)
    return base, base + "/raw", base + "/ledger", base + "/wh"


def _land(spark, root, rows, day=RUN):
    raw_zone.write_raw(rows, root, "transactions", F.lit(day).cast("timestamp_ntz"))


def _ids(lo, hi):
    return lambda spark: spark.range(lo, hi).select(F.col("id").alias("txn_id")).coalesce(1)


def _folder(root, day="01"):
    path = f"{root}/table_name=transactions/year=2026/month=01/day={day}".replace("file:", "")
    os.makedirs(path, exist_ok=True)
    return path


def test_empty_and_tiny_files(spark):
    base, root, ledger, wh = _zone(spark)
    _land(spark, root, _ids(0, 50)(spark))
    _folder(root, "02")
    import pyarrow as pa
    import pyarrow.parquet as pq
    pq.write_table(pa.table({"txn_id": pa.array([], pa.int64())}), _folder(root, "02") + "/empty.parquet")
    with open(_folder(root, "03") + "/tiny.parquet", "wb") as fh:
        fh.write(b"PAR1")                                   # no footer: not a file of no rows
    for _ in range(2):
        out = raw_zone.ledger_load(spark, root, "transactions", ledger, wh)
        assert [os.path.basename(r.file_path) for r in out["unloaded"].collect()] == ["tiny.parquet"]
    done = {os.path.basename(r.file_path): r.n_rows for r in raw_zone.read_ledger(spark, ledger).collect()}
    assert done.pop("empty.parquet") == 0 and list(done.values()) == [50]
    assert spark.read.parquet(wh).count() == 50


def test_half_broken_file_is_loaded_whole_or_not_at_all(spark):
    base, root, ledger, wh = _zone(spark)
    noise = spark.range(200_000).select(F.col("id").alias("txn_id"), F.sha2(F.col("id").cast("string"), 256).alias("reference"))
    (noise.coalesce(1).write.option("parquet.block.size", 1 << 20).parquet(base + "/one"))
    one = next(f for f in os.listdir((base + "/one").replace("file:", "")) if f.endswith(".parquet"))
    with open(f"{base}/one/{one}".replace("file:", ""), "rb") as fh:
        content = bytearray(fh.read())
    whole = bytes(content)
    at = int(len(content) * 0.7)
    content[at:at + 4096] = bytes(b ^ 0xFF for b in content[at:at + 4096])
    _land(spark, root, _ids(0, 20)(spark).withColumn("reference", F.lit("x")))
    with open(_folder(root) + "/half.parquet", "wb") as fh:
        fh.write(content)
    out = raw_zone.ledger_load(spark, root, "transactions", ledger, wh)
    assert [os.path.basename(r.file_path) for r in out["unloaded"].collect()] == ["half.parquet"]
    assert spark.read.parquet(wh).count() == 20
    with open(_folder(root) + "/half.parquet", "wb") as fh:
        fh.write(whole)                                     # mended: the next run takes all of it
    raw_zone.ledger_load(spark, root, "transactions", ledger, wh)
    assert spark.read.parquet(wh).count() == 200_020


def test_runs_with_default_or_repeated_arguments_keep_every_row(spark):
    for ts in (None, RUN):
        base, root, ledger, wh = _zone(spark)
        _land(spark, root, _ids(0, 100)(spark))
        raw_zone.ledger_load(spark, root, "transactions", ledger, wh, run_ts=ts)
        _land(spark, root, _ids(100, 150)(spark))
        for _ in range(2):
            raw_zone.ledger_load(spark, root, "transactions", ledger, wh, run_ts=ts)
        got = [r.txn_id for r in spark.read.parquet(wh).collect()]
        assert sorted(got) == list(range(150))


def test_crash_between_the_two_writes_loads_once(spark, monkeypatch):
    base, root, ledger, wh = _zone(spark)
    _land(spark, root, _ids(0, 100)(spark))
    with monkeypatch.context() as m:
        m.setattr(commits, "commit", lambda *a: 1 / 0)   # after the data, before the ledger
        try:
            raw_zone.ledger_load(spark, root, "transactions", ledger, wh, run_ts=RUN)
        except ZeroDivisionError:
            pass
    assert spark.read.parquet(wh).count() == 100
    _land(spark, root, _ids(100, 130)(spark))
    raw_zone.ledger_load(spark, root, "transactions", ledger, wh, run_ts="2026-01-02 01:00:00")
    assert sorted(r.txn_id for r in spark.read.parquet(wh).collect()) == list(range(130))
    assert raw_zone.read_ledger(spark, ledger).agg(F.sum("n_rows")).first()[0] == 130


def test_a_failing_store_is_not_an_empty_table(spark):
    path = shared_dir(spark, "t", uuid.uuid4().hex)
    assert raw_zone.read_or_empty(spark, path, "a int").count() == 0
    with pytest.raises(Exception):
        raw_zone.read_or_empty(spark, "nosuchscheme://x/y", "a int").count()


def test_every_table_lands_with_all_its_fields(spark):
    base = shared_dir(spark, "t", uuid.uuid4().hex)
    w = warehouse(spark, SF_SMALL)
    clients = w.raw.clients.limit(20)
    landing.publish(ingest.envelope(clients, "clients", "r", 0, "client_id"), base + "/in")
    landing.publish(spark.createDataFrame([("pg.nosuch", "1", "{}"), ("pg.clients", "2", None)],
                                          "topic string, message_key string, value string"), base + "/in")
    q = landing.start_landing(spark, base + "/in", base + "/raw", base + "/dlq", base + "/ckpt", S.RAW_SCHEMAS)
    q.awaitTermination()
    landed = spark.read.parquet(base + "/raw/table_name=clients").select(*clients.columns)
    key = lambda df: sorted((str(r.asDict()) for r in df.collect()))
    assert key(landed) == key(clients)
    bad = {r.error_msg for r in landing.read_dead_letters(spark, base + "/dlq").collect()}
    assert bad == {"unknown_table", "malformed_json"}


def test_dead_letters_of_nothing(spark):
    assert landing.read_dead_letters(spark, shared_dir(spark, "t", uuid.uuid4().hex)).count() == 0


def test_stream_dedup_keeps_late_and_undated_rows(spark):
    base = shared_dir(spark, "t", uuid.uuid4().hex)
    times = [None, "2026-03-01 00:00:00", "2026-01-01 00:00:00"]
    for n, ts in enumerate(times):                          # three batches, the latest event first
        df = spark.range(5 * n, 5 * n + 8).select(F.col("id").alias("txn_id"), F.lit(ts).cast("timestamp_ntz").alias("created_at"))
        df.coalesce(1).write.mode("append").parquet(base + "/in/table_name=transactions")
        dedup.start_dedup(spark, base + "/in", "transactions", df.schema, base + "/out", base + "/ckpt").awaitTermination()
    assert sorted(r.txn_id for r in spark.read.parquet(base + "/out").collect()) == list(range(18))


def test_state_fold_ignores_other_statuses(spark):
    log = spark.createDataFrame([("a", "completed", 1), ("a", "running", 5), ("b", "completed", 2), ("b", "reset", 3),
                                 ("c", "running", 4)], "key string, status string, offset long")
    assert [tuple(r) for r in ingest.latest_state(log).collect()] == [("a", 1)]


def test_keyset_paging_matches_offset_paging(spark):
    df = spark.range(1000).select(F.col("id").alias("k"))
    a = [r.k for r in ingest.paged(df, "k", 3, 50).collect()]
    b = [r.k for r in ingest.page_after(df, "k", 149, 50).collect()]
    assert a == b == list(range(150, 200))


def test_warehouse_build_materialises_in_order(spark):
    w = warehouse(spark, SF_SMALL)
    want = w.fct_daily_merchant_sales.count()
    w2 = warehouse(spark, SF_SMALL)
    paths = w2.build(shared_dir(spark, "t", uuid.uuid4().hex))
    assert set(paths) == set(w2.MODELS)
    plan = w2.fct_daily_merchant_sales._jdf.queryExecution().optimizedPlan().toString()
    assert "lineitem" not in plan                      # reads the written table
    assert w2.fct_daily_merchant_sales.count() == want
    names = w2.register_views("v_")
    assert spark.sql("SELECT COUNT(*) FROM v_fact_transactions").first()[0] == w.fact_transactions.count()
    assert len(names) == 12


def test_refresh_builds_then_gates(spark):
    w = warehouse(spark, SF_SMALL)
    paths = w.refresh(shared_dir(spark, "t", uuid.uuid4().hex))
    assert "fct_daily_merchant_sales" in paths


def test_unreadable_file_is_reported_and_others_load(spark):
    base = shared_dir(spark, "t", uuid.uuid4().hex)
    root = base + "/raw"
    raw_zone.write_raw(spark.range(20).select(F.col("id").alias("txn_id")), root, "transactions",
                       F.lit("2026-01-01 01:00:00").cast("timestamp_ntz"))
    bad_dir = f"{root}/table_name=transactions/year=2026/month=01/day=01".replace("file:", "")
    with open(bad_dir + "/broken.parquet", "wb") as fh:
        fh.write(b"x" * 300)
    out = raw_zone.ledger_load(spark, root, "transactions", base + "/ledger", base + "/wh",
                               run_ts="2026-01-01 02:00:00")
    assert spark.read.parquet(base + "/wh").count() == 20
    assert [r.file_path.endswith("broken.parquet") for r in out["unloaded"].collect()] == [True]
    assert not raw_zone.read_ledger(spark, base + "/ledger").filter(F.col("file_path").contains("broken")).count()


def test_bucketed_tables_join_without_exchange(spark):
    from paylake.operators import recon
    w = warehouse(spark, SF_SMALL)
    want = recon.refund_net(w.raw.refunds, w.current_transactions).count()
    t = w.bucket_by_txn(shared_dir(spark, "t", uuid.uuid4().hex), 8, prefix="b" + uuid.uuid4().hex[:6])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = t["refunds"].join(t["current_transactions"].withColumnRenamed("txn_id", "original_txn_id"),
                              "original_txn_id")
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        got = recon.refund_net(t["refunds"], w.current_transactions).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(32 * 1024 * 1024))
    assert got == want


def test_stream_takeover_matches_batch(spark):
    from paylake.operators import fraud
    live = warehouse(spark, SF_SMALL).raw.live_transactions
    base = shared_dir(spark, "t", uuid.uuid4().hex)
    # land the live transactions as four time slices, one after the other
    # (arrival in event-time order) -> four micro-batches
    day = F.dayofmonth("initiated_at")
    for lo, hi in [(1, 8), (8, 16), (16, 24), (24, 32)]:
        live.filter((day >= lo) & (day < hi)).coalesce(1).write.mode("append").parquet(base + "/in")
    q = landing.start_takeover(spark, base + "/in", base + "/out", base + "/state", base + "/ckpt", live.schema)
    q.awaitTermination()
    assert q.lastProgress["batchId"] >= 3
    got = sorted(r.txn_id for r in spark.read.parquet(base + "/out").collect())
    want = sorted(r.txn_id for r in fraud.account_takeover(live).collect())
    assert got == want and len(want) > 0


def test_live_card_testing_and_spree(spark):
    live = warehouse(spark, SF_SMALL).raw.live_transactions
    base = shared_dir(spark, "t", uuid.uuid4().hex)
    live.write.parquet(base + "/in")
    for name, start in [("ct", landing.start_card_testing), ("sp", landing.start_spree)]:
        start(spark, base + "/in", f"{base}/{name}", f"{base}/ckpt_{name}", live.schema).awaitTermination()
    ct = spark.read.parquet(base + "/ct")
    sp = spark.read.parquet(base + "/sp")
    assert ct.count() > 0 and ct.agg(F.min("n_txns")).first()[0] >= 10
    assert sp.count() > 0 and sp.agg(F.min("n_currencies")).first()[0] >= 2
