"""Queries with side effects on storage: raw zone, ledger load and the
streaming jobs. Results are rows per table and day or rows themselves, never file names or
counts, so that SQL can state them.

Every call works in a fresh folder under the session's shared checkpoint
directory (``spark.checkpoint.dir``).
"""
from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from paylake import schemas as S
from paylake.operators import ingest
from paylake.plans.registry import query, warehouse
from paylake.plans.oracle_base import with_ctes
from paylake.plans.queries_ops import CUTOFF, TS_MS, TXN_COLS, _corrupted, _range_count
from paylake.session import shared_dir
from paylake.sources import commits, raw_zone, state
from paylake.streaming import dedup, detectors, landing

LANDED = ["transactions", "clients", "merchants", "countries", "refunds", "fraud_alerts"]
RUN_1, RUN_2 = "2026-01-01 01:00:00", "2026-01-02 01:00:00"   # landing times of two loader runs


def _scratch(spark, name: str) -> str:
    return shared_dir(spark, "paylake", f"{name}-{uuid.uuid4().hex[:8]}")


def _landed_at(ts: str):
    return F.lit(ts).cast("timestamp_ntz")


def _write_zone(spark, sf, root):
    """Land six raw tables in one run; the partition date is the landing
    (ingestion) date, as in the landing writer."""
    raw = warehouse(spark, sf).raw
    for t in LANDED:
        raw_zone.write_raw(getattr(raw, t), root, t, _landed_at(RUN_1))


@query("raw_zone_write", with_ctes(["raw_" + t for t in LANDED], " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, 2026 AS year, 1 AS month, 1 AS day, COUNT(*) AS n_rows FROM raw_{t}"
    for t in LANDED)))
def raw_zone_write(spark, sf):
    """Land six raw tables as date-partitioned Parquet; read back rows per
    table and landing day."""
    root = _scratch(spark, "raw")
    _write_zone(spark, sf, root)
    return (spark.read.parquet(root).groupBy("table_name", "year", "month", "day")
                 .agg(F.count("*").alias("n_rows")))


_LANDED_ROWS = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, DATE '2026-01-01' AS landing_day, COUNT(*) AS n_rows FROM raw_{t}" for t in LANDED)


def _rows_by_day(listing, rows):
    """Rows per table and landing day of the listed files (rows counted by file)."""
    by_file = rows.select(F.col("_metadata.file_path").alias("file_path")).groupBy("file_path").agg(F.count("*").alias("n"))
    return (listing.join(by_file, "file_path")
            .groupBy("table_name", raw_zone.landing_day(F.col("file_path")).alias("landing_day"))
            .agg(F.sum("n").alias("n_rows")))


@query("raw_file_listing", with_ctes(["raw_" + t for t in LANDED], _LANDED_ROWS))
def raw_file_listing(spark, sf):
    """Every landed file is listed: rows per table and landing day of the listed files."""
    root = _scratch(spark, "raw")
    _write_zone(spark, sf, root)
    return _rows_by_day(raw_zone.list_files(spark, root), spark.read.parquet(root))


@query("ingest_metrics", with_ctes(["raw_" + t for t in LANDED], " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, COUNT(*) AS n_rows FROM raw_{t}" for t in LANDED)))
def ingest_metrics(spark, sf):
    """Rows per landed table (A5)."""
    root = _scratch(spark, "raw")
    _write_zone(spark, sf, root)
    return spark.read.parquet(root).groupBy("table_name").agg(F.count("*").alias("n_rows"))


@query("ledger_load", with_ctes(["raw_transactions"],
                                "SELECT *, 2026 AS year, 1 AS month, 1 AS day FROM raw_transactions"))
def ledger_load(spark, sf):
    """Load the landed transactions twice through the ledger; the second
    run finds no new file, so the target holds each row once (lineage
    columns ``source_file`` and ``load`` left out of the result)."""
    root = _scratch(spark, "raw")
    _write_zone(spark, sf, root)
    ledger, target = root + "_ledger", root + "_wh"
    schema = warehouse(spark, sf).raw.transactions.schema
    raw_zone.ledger_load(spark, root, "transactions", ledger, target, run_ts="2026-01-01 01:00:00", schema=schema)
    raw_zone.ledger_load(spark, root, "transactions", ledger, target, run_ts="2026-01-01 02:00:00", schema=schema)
    return commits.read_loads(spark, target, ledger).drop("source_file", "load")


@query("unprocessed_files", with_ctes(["raw_transactions"], """
SELECT 'transactions' AS table_name, DATE '2026-01-02' AS landing_day, COUNT(*) AS n_rows FROM raw_transactions
WHERE created_at IS NULL OR created_at >= TIMESTAMP '2025-07-01 00:00:00'"""))
def unprocessed_files(spark, sf):
    """Files landed after the last load are the next run's work."""
    root = _scratch(spark, "raw")
    raw = warehouse(spark, sf).raw
    is_late = F.coalesce(F.col("created_at") >= F.lit("2025-07-01").cast("timestamp_ntz"), F.lit(True))
    early = raw.transactions.filter(~is_late)
    raw_zone.write_raw(early, root, "transactions", _landed_at(RUN_1))
    ledger, target = root + "_ledger", root + "_wh"
    raw_zone.ledger_load(spark, root, "transactions", ledger, target, run_ts="2026-01-01 01:00:00",
                         schema=raw.transactions.schema)
    late = raw.transactions.filter(is_late)
    raw_zone.write_raw(late, root, "transactions", _landed_at(RUN_2))
    todo = raw_zone.unprocessed(raw_zone.list_files(spark, root), raw_zone.read_ledger(spark, ledger))
    return _rows_by_day(todo, spark.read.parquet(root))


def _land(spark, sf):
    w = warehouse(spark, sf)
    base = _scratch(spark, "landing")
    src, raw_root, dlq = base + "/in", base + "/raw", base + "/dlq"
    landing.publish(_corrupted(w), src)
    q = landing.start_landing(spark, src, raw_root, dlq, base + "/ckpt", {"transactions": S.RAW_SCHEMAS["transactions"]})
    q.awaitTermination()
    return base, raw_root, dlq


@query("landing_stream", with_ctes(["dlq_decoded"], "SELECT regexp_replace(topic, '^pg\\.', '') AS table_name, "
                                   + ", ".join(TXN_COLS) + " FROM dlq_decoded WHERE error_msg IS NULL"))
def landing_stream(spark, sf):
    """Messages -> decode -> dead-letter split -> raw zone, as one streaming
    query with an ``availableNow`` trigger; returns the landed rows (the
    landing-date and batch partition columns left out)."""
    _, raw_root, _ = _land(spark, sf)
    return spark.read.parquet(raw_root).drop("year", "month", "day", "batch", ingest.RESCUED)


LAND_ALL = [t for t, _, _, _ in S.TABLE_CATALOGUE]


@query("landing_tables", with_ctes(["raw_" + t for t in LAND_ALL if t != "settlement_batches"] + ["settlement_batches"], " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, COUNT(*) AS n_rows FROM {'' if t == 'settlement_batches' else 'raw_'}{t}" for t in LAND_ALL)))
def landing_tables(spark, sf):
    """All tables' messages through the landing stream: rows landed per table."""
    w = warehouse(spark, sf)
    base = _scratch(spark, "landing")
    for t, _, _, key in S.TABLE_CATALOGUE:
        df = w.settlement_batches if t == "settlement_batches" else getattr(w.raw, t)
        key = key if key in df.columns else df.columns[0]
        landing.publish(ingest.envelope(df, t, "r", TS_MS, key), base + "/in")
    landing.start_landing(spark, base + "/in", base + "/raw", base + "/dlq", base + "/ckpt", S.RAW_SCHEMAS).awaitTermination()
    return spark.read.option("mergeSchema", "false").parquet(base + "/raw").groupBy("table_name").agg(F.count("*").alias("n_rows"))


@query("stream_dedup", with_ctes(["dlq_decoded"], """
SELECT DISTINCT txn_id FROM dlq_decoded
WHERE error_msg IS NULL AND txn_id IS NOT NULL"""))
def stream_dedup(spark, sf):
    """Keyed stream dedup of the landed rows; which copy of a duplicated key
    survives depends on arrival, so the result is the surviving key set."""
    base, raw_root, _ = _land(spark, sf)
    dedup.start_dedup(spark, raw_root, "transactions", S.RAW_SCHEMAS["transactions"], base + "/dedup",
                      base + "/ckpt_dedup").awaitTermination()
    return spark.read.parquet(base + "/dedup").select("txn_id")


@query("stream_velocity", with_ctes(["live_transactions"], """
, wins AS (
  SELECT client_id, time_bucket(INTERVAL 1 MINUTE, initiated_at) - to_minutes(CAST(i AS BIGINT)) AS window_start
  FROM (SELECT client_id, initiated_at, unnest(range(0, 10)) AS i FROM live_transactions)),
wm AS (SELECT max(initiated_at) - INTERVAL 15 MINUTE AS w FROM live_transactions)
SELECT client_id, window_start, window_start + INTERVAL 10 MINUTE AS window_end, COUNT(*) AS n_txns
FROM wins GROUP BY 1, 2
HAVING COUNT(*) >= 5 AND window_start + INTERVAL 10 MINUTE <= (SELECT w FROM wm)"""))
def stream_velocity(spark, sf):
    """Live velocity windows over the live transactions written as a file
    stream: 10-minute windows every minute with at least five transactions,
    emitted once the watermark (15 minutes behind the latest event) has
    passed the window's end."""
    live = warehouse(spark, sf).raw.live_transactions
    base = _scratch(spark, "velocity")
    live.write.parquet(base + "/in")
    q = landing.start_velocity(spark, base + "/in", base + "/out", base + "/ckpt", live.schema)
    q.awaitTermination()
    return spark.read.parquet(base + "/out")


# arrival of the live transactions: hours late by transaction, in three batches by arrival time
_ARRIVAL = """, arriving AS (
  SELECT *, initiated_at + to_hours(CAST(CASE WHEN (txn_id // 100) % 50 = 0 THEN 72 ELSE (txn_id // 100 + txn_id % 100) % 5 END AS INTEGER)) AS arrives
  FROM live_transactions),
span AS (SELECT min(initiated_at) AS lo, max(initiated_at) - min(initiated_at) AS w FROM live_transactions),
batched AS (
  SELECT a.*, CASE WHEN arrives < lo + w / 3 THEN 0 WHEN arrives < lo + w * 2 / 3 THEN 1 ELSE 2 END AS b
  FROM arriving a, span),
marks AS (
  SELECT max(initiated_at) FILTER (b = 0) - INTERVAL 6 HOUR AS m0, max(initiated_at) FILTER (b <= 1) - INTERVAL 6 HOUR AS m1
  FROM batched),
judged AS (SELECT b.*, (b = 1 AND initiated_at < m0) OR (b = 2 AND initiated_at < m1) AS late FROM batched b, marks)"""


def _arrive(spark, sf, detector, name):
    """Run a live detector over the live transactions, arriving in three batches out of time
    order, some of them after the watermark; each batch is a run of its own on one checkpoint."""
    live = warehouse(spark, sf).raw.live_transactions
    base = _scratch(spark, name)
    span = live.agg(F.min("initiated_at").alias("lo"), F.max("initiated_at").alias("hi")).first()
    event, part_of = F.floor(F.col("txn_id") / 100), F.col("txn_id") % 100
    lateness = F.when(event % 50 == 0, 72).otherwise((event + part_of) % 5)
    arrives = F.timestamp_add("HOUR", lateness.cast("int"), F.col("initiated_at"))
    cuts = [commits.ntz(span.lo + (span.hi - span.lo) * k / 3) for k in (1, 2)] if span.lo else [F.lit(None)] * 2
    parts = [arrives < cuts[0], (arrives >= cuts[0]) & (arrives < cuts[1]), arrives >= cuts[1]]
    for part in parts:
        live.filter(part).write.mode("append").parquet(base + "/in")
        detectors.start(spark, detector, spark.readStream.schema(live.schema).parquet(base + "/in"), base + "/out",
                        base + "/late", base + "/state", base + "/ckpt", delay_s=6 * 3600).awaitTermination()
    return base


def _live(spark, sf, detector, name):
    base = _arrive(spark, sf, detector, name)
    flagged = detectors.read_flagged(spark, detector, base + "/out")
    return flagged.unionByName(detectors.undecided(spark, detector, base + "/state", base + "/ckpt"))


@query("live_velocity", with_ctes(["live_transactions"], _ARRIVAL + "," + _range_count(600, "NOT late", source="judged") + """
SELECT txn_id, client_id, initiated_at, n_in_window FROM lw WHERE n_in_window >= 5"""))
def live_velocity(spark, sf):
    """Velocity bursts found live in three batches out of time order: those of the batch
    detector over all rows that came before the watermark had passed them."""
    return _live(spark, sf, detectors.VELOCITY, "velocity")


@query("live_card_testing", with_ctes(["live_transactions"], _ARRIVAL + "," + _range_count(
    900, "NOT late AND channel = 'ONLINE' AND amount BETWEEN 0.01 AND 1.99", source="judged") + """
SELECT txn_id, client_id, amount, initiated_at, n_in_window FROM lw WHERE n_in_window >= 10"""))
def live_card_testing(spark, sf):
    return _live(spark, sf, detectors.CARD_TESTING, "cards")


@query("live_spree", with_ctes(["live_transactions"], _ARRIVAL + "," + _range_count(
    135 * 60, "NOT late AND currency <> 'USD'",
    extra=", CAST(len(list_distinct(list(currency) OVER (PARTITION BY client_id ORDER BY epoch_us(initiated_at) "
          "RANGE BETWEEN 8100000000 PRECEDING AND CURRENT ROW))) AS INTEGER) AS n_currencies", source="judged") + """
SELECT txn_id, client_id, initiated_at, n_in_window, n_currencies FROM lw
WHERE n_in_window >= 3 AND n_currencies >= 2"""))
def live_spree(spark, sf):
    return _live(spark, sf, detectors.SPREE, "spree")


@query("live_late_rows", with_ctes(["live_transactions"], _ARRIVAL + """
SELECT txn_id, client_id, initiated_at, 'late' AS reason FROM judged WHERE late"""))
def live_late_rows(spark, sf):
    """Transactions that arrived after the watermark had passed them: set aside with the reason."""
    base = _arrive(spark, sf, detectors.VELOCITY, "late")
    return detectors.read_aside(spark, base + "/late").select("txn_id", "client_id", "initiated_at", "reason")


# two polls of the catalogue with rows in between; merchants are asked for again after the first
_RESET = "merchants"


def _polls_sql() -> str:
    parts = []
    for t, wm, _, _ in S.TABLE_CATALOGUE:
        src = t if t == "settlement_batches" else "raw_" + t
        if wm is None:
            parts.append(f"SELECT 0 AS seq, '{t}' AS table_name, 'completed' AS status, CAST(NULL AS TIMESTAMP) AS watermark, "
                         f"COUNT(*) AS n_rows FROM {src}")
            continue
        early = f"(SELECT * FROM {src} WHERE {wm} IS NULL OR {wm} <= TIMESTAMP '{CUTOFF}')"
        parts.append(f"SELECT 0, '{t}', 'completed', MAX({wm}), COUNT(*) FROM {early}")
        if t == _RESET:
            parts += [f"SELECT 1, '{t}', 'reset', NULL, 0", f"SELECT 2, '{t}', 'completed', MAX({wm}), COUNT(*) FROM {src}"]
        else:
            mark = f"(SELECT MAX({wm}) FROM {early})"
            parts.append(f"SELECT 2, '{t}', 'watermark', "
                         f"greatest(MAX({wm}), {mark}), COUNT(*) FROM {src} WHERE {mark} IS NULL OR {wm} >= {mark}")
    return "SELECT * FROM (" + " UNION ALL ".join(parts) + ") AS t(seq, table_name, status, watermark, n_rows)"


@query("load_state", with_ctes(["raw_" + t for t in LAND_ALL if t != "settlement_batches"] + ["settlement_batches"], _polls_sql()))
def load_state(spark, sf):
    """The stored changelog after two polls with rows in between and a reset: marker, reset and
    watermark per table, with the rows each poll read."""
    w = warehouse(spark, sf).pin("transactions")
    base = _scratch(spark, "polls")
    tables = {t: w.settlement_batches if t == "settlement_batches" else getattr(w.raw, t) for t in LAND_ALL}
    marks = {t: wm for t, wm, _, _ in S.TABLE_CATALOGUE}
    late = F.lit(CUTOFF).cast("timestamp_ntz")
    early = {t: df if marks[t] is None else df.filter(F.col(marks[t]).isNull() | (F.col(marks[t]) <= late)) for t, df in tables.items()}
    state.poll(spark, early, marks, base + "/state", base + "/raw")
    state.reset(spark, base + "/state", [_RESET])
    state.poll(spark, tables, marks, base + "/state", base + "/raw")
    return state.entries(spark, base + "/state")
