"""Streams: identity of batches, dedup by stored keys, live detectors against the batch ones."""
import os
import uuid

import pytest
from pyspark.sql import functions as F

from paylake.operators import ingest
from paylake.session import shared_dir
from paylake.sources import commits, raw_zone
from paylake.streaming import dedup, detectors, landing

SCHEMA = "txn_id bigint, note string"


def _base(spark):
    return shared_dir(spark, "t", uuid.uuid4().hex)


def _struct(spark, ddl=SCHEMA):
    return spark.createDataFrame([], ddl).schema


def _send(spark, base, rows, table="transactions", ddl=SCHEMA, key="txn_id"):
    landing.publish(ingest.envelope(spark.createDataFrame(rows, ddl), table, "c", 0, key), base + "/in")


def _land(spark, base, ckpt="/ckpt", schemas=None):
    landing.start_landing(spark, base + "/in", base + "/raw", base + "/dlq", base + ckpt,
                          schemas or {"transactions": _struct(spark)}).awaitTermination()


# landing

def test_a_new_checkpoint_lands_beside_the_old(spark):
    base = _base(spark)
    _send(spark, base, [(1, "a"), (2, "b")])
    _land(spark, base)
    _send(spark, base, [(9, "c")])
    _land(spark, base)                                  # batch 1 of the first query
    landed = spark.read.parquet(base + "/raw")
    assert sorted(r.txn_id for r in landed.collect()) == [1, 2, 9]
    other = _base(spark)                                # a source of its own, batch 0 of another query, same root
    _send(spark, other, [(5, "d")])
    landing.start_landing(spark, other + "/in", base + "/raw", base + "/dlq", other + "/ckpt",
                          {"transactions": _struct(spark)}).awaitTermination()
    assert sorted(r.txn_id for r in spark.read.parquet(base + "/raw").collect()) == [1, 2, 5, 9]


def test_a_replay_on_another_day_writes_the_same_folders(spark):
    base = _base(spark)
    _send(spark, base, [(1, "a"), (2, "b")])
    _land(spark, base)
    before = {r.p: r.n for r in spark.read.parquet(base + "/raw").groupBy(F.input_file_name().alias("p")).agg(F.count("*").alias("n")).collect()}
    name = landing.batch_name(spark, base + "/ckpt", 0)
    # as if the first attempt had been on another day and died before Spark recorded the batch
    raw, ckpt = (base + p for p in ("/raw", "/ckpt"))
    (spark.range(1).select(F.lit("2026-01-31 23:59:00").cast("timestamp_ntz").alias("landed_at")).coalesce(1)
          .write.mode("overwrite").parquet(f"{raw}/_batches/batch={name}"))
    commits.remove(spark, f"{raw}/table_name=transactions")
    commits.remove(spark, f"{ckpt}/commits/0")
    commits.remove(spark, f"{ckpt}/commits/.0.crc")
    for _ in range(2):
        _land(spark, base)
        rows = spark.read.parquet(raw).collect()
        assert sorted((r.txn_id, r.year, int(r.month), int(r.day), r.batch) for r in rows) == [
            (i, 2026, 1, 31, name) for i in (1, 2)]
        commits.remove(spark, f"{ckpt}/commits/0")
        commits.remove(spark, f"{ckpt}/commits/.0.crc")
    assert len(before) >= 1


def _no_cache(spark, monkeypatch):
    """Names of the cache calls made from now on."""
    calls = []
    for name in ("persist", "cache"):
        monkeypatch.setattr(type(spark.range(0)), name, lambda self, *a, n=name: calls.append(n) or self)
    return calls


def test_landing_holds_no_batch_on_executors(spark, monkeypatch):
    base, calls = _base(spark), _no_cache(spark, monkeypatch)
    schemas = {"transactions": _struct(spark), "fraud_alerts": _struct(spark, "alert_id bigint, txn_id bigint, rule string")}
    rows = spark.range(40_000).selectExpr("id AS txn_id", "IF(id % 7 = 0, NULL, md5(CAST(id AS STRING))) AS note").coalesce(1)
    landing.publish(ingest.envelope(rows, "transactions", "c", 0, "txn_id"), base + "/in")
    _send(spark, base, [(7, 3, "r"), (8, None, None)], "fraud_alerts", "alert_id bigint, txn_id bigint, rule string", "alert_id")
    landing.publish(spark.createDataFrame([("pg.transactions", "1", "["), ("pg.transactions", "2", '{"txn_id": "x"}'), ("pg.nosuch", "3", "{}")],
                                          landing.MESSAGE_SCHEMA), base + "/in")
    merge = "spark.sql.adaptive.coalescePartitions.enabled"
    was = spark.conf.get(merge)
    spark.conf.set(merge, "false")
    try:
        q = landing.start_landing(spark, base + "/in", base + "/raw", base + "/dlq", base + "/ckpt", schemas)
        q.awaitTermination()
    finally:
        spark.conf.set(merge, was)
    assert calls == []
    landed = spark.read.parquet(base + "/raw/table_name=transactions")
    assert sorted(map(tuple, landed.select("txn_id", "note").collect())) == sorted(map(tuple, rows.collect()))
    assert len(landed.inputFiles()) > 1     # the rows of one task and day are dealt, not sent in one block
    assert sorted(r.alert_id for r in spark.read.parquet(base + "/raw/table_name=fraud_alerts").collect()) == [7, 8]
    assert sorted((r.message_key, r.value, r.error_msg, r.original_topic) for r in landing.read_dead_letters(spark, base + "/dlq").collect()) == [
        ("1", "[", "malformed_json", "pg.transactions"), ("2", '{"txn_id": "x"}', "type_mismatch:txn_id", "pg.transactions"),
        ("3", "{}", "unknown_table", "pg.nosuch")]
    seen = [p["observedMetrics"]["ingest"] for p in q.recentProgress if p["numInputRows"]]
    assert [(r["messages"], r["transactions"], r["fraud_alerts"]) for r in seen] == [(40_005, 40_002, 2)]    # the source is read once
    assert os.listdir(f"{base}/raw/_staged".replace("file://", "").replace("file:", "")) == []


def test_a_landing_that_dies_leaves_staged_rows_to_its_replay(spark, monkeypatch):
    base = _base(spark)
    _send(spark, base, [(1, "a"), (2, "b")])
    landing.publish(spark.createDataFrame([("pg.transactions", "3", "[")], landing.MESSAGE_SCHEMA), base + "/in")
    staged = f"{base}/raw/_staged".replace("file://", "").replace("file:", "")
    with monkeypatch.context() as m:
        m.setattr(landing.commits, "remove", lambda *a: 1 / 0)
        with pytest.raises(Exception):
            _land(spark, base)
    assert len(os.listdir(staged)) == 1
    _land(spark, base)
    assert sorted(r.txn_id for r in spark.read.parquet(base + "/raw").collect()) == [1, 2] and os.listdir(staged) == []
    assert [r.message_key for r in landing.read_dead_letters(spark, base + "/dlq").collect()] == ["3"]


# dedup

def test_two_tables_in_one_root_stay_apart(spark):
    base = _base(spark)
    schemas = {"transactions": _struct(spark), "fraud_alerts": _struct(spark, "alert_id bigint, txn_id bigint, rule string")}
    _send(spark, base, [(1, "a"), (2, "b"), (1, "z")])
    _send(spark, base, [(7, 3, "r")], "fraud_alerts", "alert_id bigint, txn_id bigint, rule string", "alert_id")
    _land(spark, base, schemas=schemas)
    for table, key in (("transactions", "txn_id"), ("fraud_alerts", "alert_id")):
        dedup.start_dedup(spark, base + "/raw", table, schemas[table], f"{base}/{table}", f"{base}/ck_{table}", key).awaitTermination()
    got = spark.read.parquet(base + "/transactions")
    assert sorted(r.txn_id for r in got.collect()) == [1, 2] and "note" in got.columns and "rule" not in got.columns
    assert [(r.alert_id, r.txn_id, r.rule) for r in spark.read.parquet(base + "/fraud_alerts").collect()] == [(7, 3, "r")]


def _dedup(spark, base, schema, **more):
    return dedup.start_dedup(spark, base + "/raw", "t", schema, base + "/out", base + "/ckpt", **more)


def test_dedup_reads_its_own_buckets_only(spark):
    base, schema = _base(spark), _struct(spark)
    sizes = []
    for n in range(6):                                  # ids given out in order, with some copies of the batch before
        ids = spark.range(max(0, 1000 * n - 200), 1000 * (n + 1)).selectExpr("id AS txn_id", "'x' AS note")
        ids.write.mode("append").parquet(base + "/raw/table_name=t/batch=" + str(n))
        touched = sorted({r.b for r in ids.select(dedup.bucket_of(F.col("txn_id"), schema["txn_id"].dataType, 1000).alias("b")).collect()})
        files = dedup.stored_keys(spark, base + "/out_keys", "txn_id", schema["txn_id"].dataType, touched).inputFiles()
        sizes.append(sum(os.path.getsize(f.replace("file://", "")) for f in files))
        assert all(any(f"/bucket={b}/" in f for b in touched) for f in files)
        _dedup(spark, base, schema, block=1000).awaitTermination()
    assert sorted(r.txn_id for r in spark.read.parquet(base + "/out").collect()) == list(range(6000))
    assert sizes[0] == 0 and max(sizes[2:]) <= 1.2 * sizes[1]       # does not grow with history
    # a late copy of an old key and a new key of text
    spark.createDataFrame([(3, "late"), (6000, "new"), (None, "no key")], SCHEMA).write.parquet(base + "/raw/table_name=t/batch=z")
    _dedup(spark, base, schema, block=1000).awaitTermination()
    assert [r.txn_id for r in spark.read.parquet(base + "/out").filter("note = 'new' OR note = 'late'").collect()] == [6000]


def test_dedup_replay_and_text_keys(spark):
    base, schema = _base(spark), _struct(spark, "txn_id string, note string")
    spark.createDataFrame([("a", "1"), ("b", "1"), ("a", "1")], schema).write.parquet(base + "/raw/table_name=t/batch=0")
    _dedup(spark, base, schema).awaitTermination()
    for _ in range(2):                                  # the batch ran, its commit was lost
        for f in ("0", ".0.crc"):
            commits.remove(spark, f"{base}/ckpt/commits/{f}")
        _dedup(spark, base, schema).awaitTermination()
        assert sorted(r.txn_id for r in spark.read.parquet(base + "/out").collect()) == ["a", "b"]
    commits.remove(spark, base + "/ckpt")               # a new checkpoint over the same store adds nothing
    _dedup(spark, base, schema).awaitTermination()
    assert sorted(r.txn_id for r in spark.read.parquet(base + "/out").collect()) == ["a", "b"]


def test_dedup_holds_no_batch_on_executors(spark, monkeypatch):
    base, schema, calls = _base(spark), _struct(spark), _no_cache(spark, monkeypatch)
    for n, rows in enumerate([[(1, "a"), (1, "b"), (2, "c"), (None, "d")], [(2, "e"), (3, "f"), (3, "g"), (None, "h")]]):
        spark.createDataFrame(rows, SCHEMA).write.parquet(f"{base}/raw/table_name=t/batch={n}")
        _dedup(spark, base, schema).awaitTermination()
    assert calls == []
    got = {r.txn_id: r.note for r in spark.read.parquet(base + "/out").collect()}
    assert sorted(got) == [1, 2, 3] and got[1] in "ab" and got[2] == "c" and got[3] in "fg"
    assert spark.read.parquet(base + "/out").count() == spark.read.parquet(base + "/out_keys").count() == 3


# detectors

def _live(spark, rows):
    """(txn, client, minute, second) rows as live transactions of one small online amount."""
    return spark.createDataFrame(rows, "txn_id bigint, client_id bigint, m int, s int").selectExpr(
        "txn_id", "client_id", "CAST(1 AS DECIMAL(14,2)) AS amount",
        "CASE txn_id % 3 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' ELSE 'GBP' END AS currency", "'ONLINE' AS channel",
        "timestampadd(SECOND, m * 60 + s, TIMESTAMP_NTZ '2026-01-01 00:00:00') AS initiated_at")


def _batches(spark, detector, batches, delay_s, base=None):
    base = base or _base(spark)
    for rows in batches:
        rows.write.mode("append").parquet(base + "/in")
        detectors.start(spark, detector, spark.readStream.schema(rows.schema).parquet(base + "/in"), base + "/out",
                        base + "/late", base + "/state", base + "/ckpt", delay_s=delay_s).awaitTermination()
    final = detectors.read_flagged(spark, detector, base + "/out")
    return base, final, detectors.undecided(spark, detector, base + "/state", base + "/ckpt")


@pytest.mark.parametrize("name", ["VELOCITY", "CARD_TESTING", "SPREE"])
def test_live_equals_batch_out_of_time_order(spark, name):
    import random
    rng = random.Random(name)
    rows = [(i, rng.choice([1, 1, 1, 2, 3, None]), rng.choice([0, 10, 30, 90, 200, 400]) + rng.randint(0, 12), rng.randint(0, 59))
            for i in range(400)]
    batches = [_live(spark, rows[i::4]).unionByName(_live(spark, rows[i::4]).filter("txn_id = -1")) for i in range(4)]
    detector = getattr(detectors, name)
    # nothing is late: the delay covers the whole span
    _, final, rest = _batches(spark, detector, batches, 86400)
    want = sorted(map(tuple, detector.detect(_live(spark, rows)).collect()))
    assert sorted(map(tuple, final.unionByName(rest).collect())) == want and len(want) > 5


def test_live_decides_once_and_sets_late_rows_aside(spark):
    first = [(i, 1, 0, i) for i in range(4)] + [(50, 2, 60, 0)]
    second = [(4, 1, 0, 30), (60, 2, 90, 0)]                        # a fifth of client 1, an hour late
    third = [(70, 3, 200, 0), (71, None, 200, 0)]
    base, final, rest = _batches(spark, detectors.VELOCITY, [_live(spark, first), _live(spark, second), _live(spark, third)], 600)
    assert [(r.txn_id, r.reason) for r in detectors.read_aside(spark, base + "/late").collect()] == [(4, "late")]
    assert final.count() == 0 and rest.count() == 0
    # the fifth comes within the delay: flagged, once, when the watermark has passed it
    second = [(4, 1, 0, 30), (60, 2, 9, 0)]
    base, final, rest = _batches(spark, detectors.VELOCITY, [_live(spark, first[:4]), _live(spark, second)], 600)
    assert final.count() == 0 and [r.txn_id for r in rest.collect()] == [4]
    _, final, rest = _batches(spark, detectors.VELOCITY, [_live(spark, third)], 600, base)
    assert [(r.txn_id, r.n_in_window) for r in final.collect()] == [(4, 5)] and rest.count() == 0
    for f in ("2", ".2.crc"):                                       # replay of the last batch
        commits.remove(spark, f"{base}/ckpt/commits/{f}")
    undated = _live(spark, [(80, 1, 1, 0)]).withColumn("initiated_at", F.lit(None).cast("timestamp_ntz"))
    _, final, _ = _batches(spark, detectors.VELOCITY, [undated], 600, base)
    assert [(r.txn_id, r.n_in_window) for r in final.collect()] == [(4, 5)]
    assert [r.reason for r in detectors.read_aside(spark, base + "/late").collect()] == ["no_time"]
    state = f"{base}/state/{commits.query_id(spark, base + '/ckpt')}/tail".replace("file:", "")
    assert len([d for d in os.listdir(state) if not d.startswith(".")]) == 2    # older versions are gone


# loads

def _zone(spark):
    base = _base(spark)
    return base + "/raw", base + "/ledger", base + "/wh"


def _put(spark, root, lo, hi, day="2026-01-01 00:00:00"):
    raw_zone.write_raw(spark.range(lo, hi).selectExpr("id AS txn_id"), root, "transactions", F.lit(day).cast("timestamp_ntz"))


def _loaded(spark, wh, ledger):
    return sorted(r.txn_id for r in commits.read_loads(spark, wh, ledger).collect())


@pytest.mark.parametrize("where", ["_publish", "commit", "remove"])
def test_a_run_that_dies_is_finished_by_the_next(spark, monkeypatch, where):
    root, ledger, wh = _zone(spark)
    _put(spark, root, 0, 50)
    raw_zone.ledger_load(spark, root, "transactions", ledger, wh)
    _put(spark, root, 50, 90)
    with monkeypatch.context() as m:                    # before the rows, before the record, before the intent goes
        m.setattr(raw_zone if where == "_publish" else commits, where, lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            raw_zone.ledger_load(spark, root, "transactions", ledger, wh)
    assert _loaded(spark, wh, ledger) == list(range(90 if where == "remove" else 50))
    _put(spark, root, 90, 95, "2026-01-02 00:00:00")
    raw_zone.ledger_load(spark, root, "transactions", ledger, wh)
    assert _loaded(spark, wh, ledger) == list(range(95))
    assert raw_zone.read_ledger(spark, ledger).agg(F.sum("n_rows")).first()[0] == 95
    assert commits.pending(spark, ledger) == []


def test_a_replayed_batch_loads_once(spark):
    root, ledger, wh = _zone(spark)
    _put(spark, root, 0, 10)
    for _ in range(2):
        raw_zone.ledger_load(spark, root, "transactions", ledger, wh, batch="q-1")
        _put(spark, root, 10, 20)                       # comes after the batch: the replay leaves it to the next
    assert _loaded(spark, wh, ledger) == list(range(10))


def test_no_load_scans_earlier_loads(spark, monkeypatch):
    root, ledger, wh = _zone(spark)
    for n in range(3):
        _put(spark, root, 10 * n, 10 * n + 10, f"2026-01-{n + 1:02d} 00:00:00")
        raw_zone.ledger_load(spark, root, "transactions", ledger, wh)
    old = {r.load for r in raw_zone.read_ledger(spark, ledger).select("load").distinct().collect()}
    assert len(old) == 3
    _put(spark, root, 30, 40, "2026-01-09 00:00:00")
    commits.remove(spark, wh)                           # a run that looked at earlier loads would fail or load them again
    raw_zone.ledger_load(spark, root, "transactions", ledger, wh)
    assert sorted(r.txn_id for r in spark.read.parquet(wh).collect()) == list(range(30, 40))


def test_listing_from_a_day_on(spark):
    root, ledger, wh = _zone(spark)
    days = ["2025-12-31", "2026-01-01", "2026-01-15", "2026-01-31", "2026-02-01", "2026-12-01", "2027-03-01"]
    for n, d in enumerate(days):
        _put(spark, root, n, n + 1, d + " 00:00:00")
    import datetime as dt
    folder = root + "/table_name=transactions"
    for since in ("2025-01-01", "2026-01-01", "2026-01-16", "2026-02-01", "2026-12-02", "2027-03-02"):
        listed = raw_zone.list_files(spark, folder, dt.date.fromisoformat(since))
        got = [str(r.d) for r in listed.select(raw_zone.landing_day(F.col("file_path")).alias("d")).collect()]
        assert sorted(got) == [d for d in days if d >= since]


def test_row_groups_are_bounded(spark):
    import pyarrow.parquet as pq
    root, _, _ = _zone(spark)
    raw_zone.write_raw(spark.range(250_000).selectExpr("id AS txn_id").coalesce(1), root, "transactions",
                       F.lit("2026-01-01 00:00:00").cast("timestamp_ntz"))
    files = [f.replace("file://", "") for f in spark.read.parquet(root).inputFiles()]
    groups = [pq.ParquetFile(f).metadata.row_group(i).num_rows for f in files for i in range(pq.ParquetFile(f).metadata.num_row_groups)]
    assert sum(groups) == 250_000 and max(groups) <= raw_zone.ROW_GROUP and len(groups) >= 3


def test_kafka_records_carry_a_key(spark):
    from paylake.sources import connectors
    got = connectors.kafka_records(ingest.envelope(spark.createDataFrame([(1, "a")], SCHEMA), "t", "c", 0, "txn_id"))
    assert got.columns == ["topic", "key", "value"] and got.first().key == "1"
