"""Operator queries beyond the models, each with its DuckDB oracle."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from paylake import schemas as S
from paylake.operators import fraud, ingest, quality, recon
from paylake.plans.registry import query, warehouse
from paylake.plans.fixtures import corrupt
from paylake.plans.oracle_base import latest_sql, register, with_ctes
from paylake.plans.oracle_models import initcap

TXN_COLS = [f.name for f in S.RAW_SCHEMAS["transactions"].fields]
CUTOFF = "2026-06-30 00:00:00"
TS_MS = 1767225600000  # publish time stamped on the test envelopes (2026-01-01 UTC)

register("current_transactions", ["raw_transactions"],
         latest_sql("current_transactions", "raw_transactions", "txn_id", "created_at DESC NULLS FIRST",
                    TXN_COLS, "txn_id IS NOT NULL"))
register("current_status", ["current_transactions", "raw_transaction_statuses"], """
  current_status AS (
    SELECT t.*, s.code AS status_code FROM current_transactions t
    LEFT JOIN raw_transaction_statuses s ON t.status_id = s.status_id)""")


register("settlement_batches", ["current_status"], f"""
  sb_g AS (
    SELECT merchant_id, CAST(initiated_at AS DATE) AS batch_date, COUNT(*) AS txn_count,
      CAST(SUM(ABS(amount)) AS DECIMAL(16,2)) AS gross_amount, CAST(SUM(fee) AS DECIMAL(14,2)) AS total_fees
    FROM current_status WHERE status_code IN ('APPROVED','SETTLED') AND merchant_id IS NOT NULL
      AND initiated_at IS NOT NULL GROUP BY 1, 2),
  settlement_batches AS (
    SELECT merchant_id * 100000 + date_diff('day', DATE '2000-01-01', batch_date) AS batch_id,
      merchant_id, batch_date, txn_count, gross_amount, total_fees,
      CAST(gross_amount - total_fees AS DECIMAL(16,2)) AS net_payout, 'USD' AS currency,
      CASE WHEN date_diff('day', batch_date, DATE '{S.CALENDAR_END}') > 2 THEN 'SETTLED' ELSE 'PENDING' END AS status,
      CASE WHEN date_diff('day', batch_date, DATE '{S.CALENDAR_END}') > 2
           THEN CAST(batch_date AS TIMESTAMP) + INTERVAL 22 HOUR END AS settled_at,
      CAST(batch_date AS TIMESTAMP) + INTERVAL 24 HOUR AS created_at
    FROM sb_g)""")


def _w(spark, sf):
    return warehouse(spark, sf)


# ===================================================================== ingest

@query("scan_full", with_ctes(["raw_transactions"], "SELECT * FROM raw_transactions"))
def scan_full(spark, sf):
    """Full extract of a table: a partitioned parallel scan, ordered by key
    inside each partition (no global sort, no OFFSET paging)."""
    return _w(spark, sf).raw.transactions.sortWithinPartitions("txn_id")


_COUNT_TABLES = ["countries", "transaction_types", "transaction_statuses", "card_networks",
                 "merchant_categories", "merchants", "pos_terminals", "clients", "payment_cards",
                 "transactions", "fraud_alerts", "refunds"]


@query("table_row_counts", with_ctes(
    ["raw_" + t for t in _COUNT_TABLES] + ["settlement_batches"],
    " UNION ALL ".join([f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM raw_{t}" for t in _COUNT_TABLES]
                       + ["SELECT 'settlement_batches', COUNT(*) FROM settlement_batches"])))
def table_row_counts(spark, sf):
    w = _w(spark, sf).pin("transactions")
    tables = {t: getattr(w.raw, t) for t in _COUNT_TABLES} | {"settlement_batches": w.settlement_batches}
    return reduce(lambda a, b: a.unionByName(b), [
        df.agg(F.count("*").alias("row_count")).select(F.lit(t).alias("table_name"), "row_count")
        for t, df in tables.items()])


@query("incremental_extract", with_ctes(["raw_transactions"], f"""
SELECT * FROM raw_transactions WHERE created_at > TIMESTAMP '{CUTOFF}'"""))
def incremental_extract(spark, sf):
    return ingest.incremental(_w(spark, sf).raw.transactions, "created_at", CUTOFF)


_WM_TABLES = [(t, wm) for t, wm, _, _ in S.TABLE_CATALOGUE
              if wm is not None]
_STORED = {t: t if t == "settlement_batches" else "raw_" + t for t, _ in _WM_TABLES}


@query("next_watermark", with_ctes(list(_STORED.values()), " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, COALESCE(MAX({wm}), TIMESTAMP '{CUTOFF}') AS watermark, "
    f"MAX({wm}) IS NOT NULL AS advanced FROM {_STORED[t]} WHERE {wm} > TIMESTAMP '{CUTOFF}'"
    for t, wm in _WM_TABLES)))
def next_watermark(spark, sf):
    w = _w(spark, sf).pin("transactions")
    return reduce(lambda a, b: a.unionByName(b), [
        ingest.next_watermark(w.settlement_batches if t == "settlement_batches" else getattr(w.raw, t), t, wm, CUTOFF)
        for t, wm in _WM_TABLES])


@query("hybrid_load", with_ctes(["raw_transactions"], f"""
SELECT txn_id, created_at, CASE WHEN created_at > TIMESTAMP '{CUTOFF}' THEN 'c' ELSE 'r' END AS op
FROM raw_transactions"""))
def hybrid_load(spark, sf):
    raw = _w(spark, sf).raw.transactions.select("txn_id", "created_at")
    return ingest.hybrid_load(raw, "created_at", CUTOFF)


@query("preview_head", with_ctes(["stg_transactions"],
                                 "SELECT * FROM stg_transactions ORDER BY transaction_id LIMIT 5"))
def preview_head(spark, sf):
    return _w(spark, sf).stg_transactions.orderBy("transaction_id").limit(5)


@query("paged_extract", with_ctes(["stg_transactions"],
                                  "SELECT * FROM stg_transactions ORDER BY transaction_id LIMIT 500 OFFSET 1000"))
def paged_extract(spark, sf):
    return ingest.paged(_w(spark, sf).stg_transactions, "transaction_id", page=2, size=500)


@query("hash_sample", with_ctes(["current_status"], f"""
SELECT txn_id, amount FROM current_status
WHERE status_code = 'APPROVED'
  AND CAST(('0x' || substr(md5(CAST(txn_id AS VARCHAR)), 1, 8)) AS BIGINT) < {int(0.05 * 0xFFFFFFFF)}"""))
def hash_sample(spark, sf):
    """About 5 % of approved transactions, the same ones on every run."""
    w = _w(spark, sf)
    ok = recon.with_status(w.current("status_id", "amount"), w.raw.status_lookup) \
        .filter(F.col("status_code") == "APPROVED").select("txn_id", "amount")
    return ingest.hash_sample(ok, "txn_id", 0.05)


def _payload_sql(src: str) -> str:
    """DuckDB text of the producer's JSON payload of a transaction row."""
    parts = []
    for f in S.RAW_SCHEMAS["transactions"].fields:
        n, t = f.name, f.dataType.simpleString()
        if t.startswith("decimal"):
            v = f"CAST({src}.{n} AS DOUBLE)"
        elif t == "timestamp_ntz":
            v = f"strftime({src}.{n}, '%Y-%m-%dT%H:%M:%S')"
        elif t == "date":
            v = f"strftime({src}.{n}, '%Y-%m-%d')"
        else:
            v = f"{src}.{n}"
        parts.append(f"'{n}': {v}")
    return "{" + ", ".join(parts) + "}"


register("cdc_messages", ["raw_transactions"], f"""
  cdc_messages AS (
    SELECT 'pg.transactions' AS topic, CAST(txn_id AS VARCHAR) AS message_key,
      CAST(to_json({{'_meta': {{'table': 'transactions', 'op': 'r', 'ts_ms': CAST({TS_MS} AS BIGINT)}},
                     'payload': {_payload_sql('r')}}}) AS VARCHAR) AS value,
      txn_id AS _id
    FROM raw_transactions r)""")


def _messages(w):
    raw = w.raw.transactions
    return ingest.envelope(raw, "transactions", "r", TS_MS, "txn_id")


@query("cdc_envelope", with_ctes(["cdc_messages"], "SELECT topic, message_key, value FROM cdc_messages"))
def cdc_envelope(spark, sf):
    return _messages(_w(spark, sf))


def _corrupted(w):
    """Messages as consumed from the topic, some damaged in transit."""
    m = _messages(w)    # dealt over all cores by the shuffle of the transactions' join
    m = m.withColumn("_id", F.coalesce(F.col("message_key").cast("bigint"), F.lit(0)))
    return corrupt(m, F.col("_id")).drop("_id")


# the oracle damages the same messages with its own text functions
register("dlq_input", ["cdc_messages"], """
  dlq_input AS (
    SELECT topic, message_key,
      CASE WHEN COALESCE(_id, 0) % 50 = 7 THEN regexp_replace(value, '^\\{"_meta":', '{"_meta";')
           WHEN COALESCE(_id, 0) % 50 = 11 THEN '[1,2]'
           WHEN COALESCE(_id, 0) % 50 = 13 THEN regexp_replace(value, '"txn_id":[0-9]+', '"txn_id":"oops"')
           WHEN COALESCE(_id, 0) % 50 = 17 THEN regexp_extract(value, '"payload":(\\{.*\\})\\}$', 1)
           WHEN COALESCE(_id, 0) % 50 = 19 THEN NULL
           WHEN COALESCE(_id, 0) % 50 = 21 THEN ''
           WHEN COALESCE(_id, 0) % 50 = 23 THEN '  '
           WHEN COALESCE(_id, 0) % 50 = 25 THEN '{}'
           WHEN COALESCE(_id, 0) % 50 = 27 THEN '{"foo":1}'
           WHEN COALESCE(_id, 0) % 50 = 29 THEN '{"payload":{}}'
           WHEN COALESCE(_id, 0) % 50 = 15 THEN regexp_replace(value, '"payload":\\{.*\\}\\}$', '"payload":null}')
           ELSE value END AS value
    FROM cdc_messages)""")


def _duck_type(t: str) -> str:
    return {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "timestamp_ntz": "TIMESTAMP",
            "date": "DATE"}.get(t, t.upper())


def _decode_sql() -> str:
    fields = S.RAW_SCHEMAS["transactions"].fields
    mism = " ".join(
        f"WHEN json_exists(body, '$.{f.name}') AND json_type(body, '$.{f.name}') <> 'NULL' "
        f"AND TRY_CAST(json_extract_string(body, '$.{f.name}') AS {_duck_type(f.dataType.simpleString())}) IS NULL "
        f"THEN 'type_mismatch:{f.name}'" for f in fields)
    unknown = " AND ".join(f"NOT json_exists(body, '$.{f.name}')" for f in fields)
    typed = ", ".join(
        f"TRY_CAST(json_extract_string(body, '$.{f.name}') AS {_duck_type(f.dataType.simpleString())}) AS {f.name}"
        for f in fields)
    return f"""
  dlq_p AS (
    SELECT *, CASE WHEN json_valid(value) THEN CAST(value AS JSON) END AS j FROM dlq_input),
  dlq_b AS (
    SELECT *, COALESCE(json_type(j) = 'OBJECT' AND json_exists(j, '$.payload'), false) AS has_payload
    FROM dlq_p),
  dlq_c AS (
    SELECT *, CASE WHEN has_payload THEN json_extract(j, '$.payload') ELSE j END AS body FROM dlq_b),
  dlq_decoded AS (
    SELECT topic, message_key, value,
      CASE WHEN j IS NULL THEN 'malformed_json'
           WHEN json_type(j) <> 'OBJECT' THEN 'not_an_object'
           WHEN has_payload AND json_type(j, '$.payload') = 'NULL' THEN 'null_payload'
           WHEN json_type(body) <> 'OBJECT' THEN 'not_an_object'
           WHEN {unknown} THEN 'no_known_field'
           {mism}
           END AS error_msg,
      {typed}
    FROM dlq_c)"""


register("dlq_decoded", ["dlq_input"], _decode_sql())


def _decoded(w):
    return ingest.decode(_corrupted(w), S.RAW_SCHEMAS["transactions"])


@query("envelope_decode", with_ctes(["dlq_decoded"], "SELECT regexp_replace(topic, '^pg\\.', '') AS table_name, "
                                    + ", ".join(TXN_COLS) + " FROM dlq_decoded WHERE error_msg IS NULL"))
def envelope_decode(spark, sf):
    good, _ = ingest.split_dead_letters(_decoded(_w(spark, sf)), S.RAW_SCHEMAS["transactions"])
    return good


@query("dead_letter", with_ctes(["dlq_decoded"], """
SELECT message_key, value, error_msg, topic AS original_topic FROM dlq_decoded WHERE error_msg IS NOT NULL"""))
def dead_letter(spark, sf):
    _, bad = ingest.split_dead_letters(_decoded(_w(spark, sf)), S.RAW_SCHEMAS["transactions"])
    return bad


@query("normalise_types", with_ctes(["raw_transactions"], """
SELECT txn_id, CAST(amount AS DOUBLE) AS amount, CAST(fee AS DOUBLE) AS fee,
  CAST(net_amount AS DOUBLE) AS net_amount, strftime(initiated_at, '%Y-%m-%dT%H:%M:%S') AS initiated_at,
  strftime(settled_at, '%Y-%m-%d') AS settled_at, CAST(json_object('ip', ip_address, 'device', device_id) AS VARCHAR) AS client_info
FROM raw_transactions"""))
def normalise_types(spark, sf):
    t = _w(spark, sf).raw.transactions.select(
        "txn_id", "amount", "fee", "net_amount", "initiated_at", "settled_at",
        F.struct(F.col("ip_address").alias("ip"), F.col("device_id").alias("device")).alias("client_info"))
    return ingest.normalise(t)


@query("schema_align", with_ctes(["raw_transactions"], """
SELECT txn_id, reference, client_id, card_id, pos_id, merchant_id, type_id, status_id, amount, currency, fee,
  net_amount, auth_code, channel,
  CASE WHEN channel = 'POS' THEN NULL ELSE ip_address END AS ip_address,
  CASE WHEN channel = 'POS' THEN NULL ELSE device_id END AS device_id,
  is_recurring, is_international, is_flagged, failure_reason, initiated_at, processed_at, settled_at, created_at
FROM raw_transactions"""))
def schema_align(spark, sf):
    """Two landed shapes of the same table -- POS rows written without the
    online columns, other rows with an extra column -- aligned to the table
    schema and unioned."""
    raw = _w(spark, sf).raw.transactions
    pos = raw.filter(F.col("channel") == "POS").drop("ip_address", "device_id")
    other = raw.filter(F.col("channel") != "POS").withColumn("debug_note", F.lit("x"))
    return ingest.union_aligned([pos, other], S.RAW_SCHEMAS["transactions"])


@query("insert_ignore", with_ctes(["current_status"], """
, sb_all AS (
  SELECT merchant_id, CAST(initiated_at AS DATE) AS batch_date, COUNT(*) AS txn_count,
    CAST(SUM(ABS(amount)) AS DECIMAL(16,2)) AS gross_amount, CAST(SUM(fee) AS DECIMAL(14,2)) AS total_fees
  FROM current_status WHERE status_code IN ('APPROVED','SETTLED') AND merchant_id IS NOT NULL
    AND initiated_at IS NOT NULL GROUP BY 1, 2),
sb_old AS (
  SELECT merchant_id, batch_date, txn_count, 'old' AS origin FROM sb_all WHERE batch_date < DATE '2026-01-01'),
sb_new AS (
  SELECT merchant_id, batch_date, txn_count, 'new' AS origin FROM sb_all
  WHERE (merchant_id, batch_date) NOT IN (SELECT (merchant_id, batch_date) FROM sb_old))
SELECT * FROM sb_old UNION ALL SELECT * FROM sb_new"""))
def insert_ignore(spark, sf):
    """Append the recomputed settlement batches to the stored ones; rows
    whose (merchant, day) already exists are skipped, the stored row kept."""
    sb = _w(spark, sf).settlement_batches.select("merchant_id", "batch_date", "txn_count")
    old = sb.filter(F.col("batch_date") < F.lit("2026-01-01").cast("date")).withColumn("origin", F.lit("old"))
    new = sb.withColumn("origin", F.lit("new"))
    return ingest.insert_ignore(old, new, ["merchant_id", "batch_date"], [F.col("txn_count").desc()])


def _state_log(w):
    """Changelog of the load state: every table is marked completed after
    its full load; tables that received rows after the cutoff are then
    reset for a reload."""
    raw = w.raw
    parts = []
    for i, (t, wm, _, _) in enumerate(S.TABLE_CATALOGUE):
        df = w.settlement_batches if t == "settlement_batches" else getattr(raw, t)
        parts.append(df.agg(F.count("*").alias("rows")).select(
            F.lit(t).alias("key"), F.lit("completed").alias("status"), F.lit(i).alias("offset"), "rows"))
        if wm is not None:
            late = df.filter(F.col(wm) > F.lit(CUTOFF).cast("timestamp_ntz"))
            parts.append(late.agg(F.count("*").alias("rows")).filter(F.col("rows") > 0).select(
                F.lit(t).alias("key"), F.lit("reset").alias("status"), F.lit(100 + i).alias("offset"), "rows"))
    return reduce(lambda a, b: a.unionByName(b), parts)


def _state_log_sql() -> tuple[list[str], str]:
    deps, parts = [], []
    for i, (t, wm, _, _) in enumerate(S.TABLE_CATALOGUE):
        table = t if t == "settlement_batches" else "raw_" + t
        deps.append(table)
        parts.append(f"SELECT '{t}' AS key, 'completed' AS status, {i} AS off")
        if wm is not None:
            parts.append(f"SELECT '{t}', 'reset', {100 + i} FROM {table} WHERE {wm} > TIMESTAMP '{CUTOFF}' "
                         f"HAVING COUNT(*) > 0")
    return deps, "\n  state_log AS (" + " UNION ALL ".join(parts) + ")"


register("state_log", *_state_log_sql())


@query("latest_state", with_ctes(["state_log"], """
SELECT key AS table_name, max(off) AS "offset" FROM state_log GROUP BY key
HAVING arg_max(status, off) = 'completed'"""))
def latest_state(spark, sf):
    return ingest.latest_state(_state_log(_w(spark, sf).pin("transactions")))


@query("pending_tables", with_ctes(["state_log"], """
SELECT key AS table_name FROM (SELECT DISTINCT key FROM state_log) k
WHERE key NOT IN (SELECT key FROM state_log GROUP BY key HAVING arg_max(status, off) = 'completed')"""))
def pending_tables(spark, sf):
    """Catalogue tables whose full load is not (or no longer) complete."""
    w = _w(spark, sf).pin("transactions")
    done = ingest.latest_state(_state_log(w))
    catalogue = spark.createDataFrame([(t,) for t, _, _, _ in S.TABLE_CATALOGUE],
                                      "table_name string")
    return catalogue.join(done, "table_name", "left_anti")


@query("json_fields", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
  COALESCE(json_extract_string(props, '$.missing'), 'none') AS missing
FROM events""")
def json_fields(spark, sf):
    e = _w(spark, sf).t.events
    return e.select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k"),
                    F.coalesce(F.get_json_object("props", "$.missing"), F.lit("none")).alias("missing"))


@query("net_amount", with_ctes(["raw_transactions"], """
SELECT txn_id, amount, fee, CAST(amount - fee AS DECIMAL(14,2)) AS net_amount FROM raw_transactions"""))
def net_amount(spark, sf):
    t = _w(spark, sf).raw.transactions
    return t.select("txn_id", "amount", "fee", (F.col("amount") - F.col("fee")).cast("decimal(14,2)")
                    .alias("net_amount"))


# ===================================================================== quality

_STAGING_KEYS = [("stg_clients", "client_id"), ("stg_transactions", "transaction_id"),
                 ("stg_countries", "country_id"), ("stg_transaction_statuses", "status_id"),
                 ("stg_transaction_types", "type_id")]


def _dup_sql(src: str, model: str, keys: list[str]) -> str:
    nn = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    kv = " || '|' || ".join(f"CAST({k} AS VARCHAR)" for k in keys)
    return (f"SELECT '{model}' AS model, '{','.join(keys)}' AS column_name, {kv} AS key_value, "
            f"COUNT(*) AS occurrences FROM {src} WHERE {nn} GROUP BY {', '.join(keys)} HAVING COUNT(*) > 1")


def _source(table: str) -> str:
    return table if table == "settlement_batches" else "raw_" + table


_UNIQUE_CHECKS = ([(m, m, [k]) for m, k in _STAGING_KEYS]
                  + [(_source(t), t, keys) for t, keys in quality.SOURCE_UNIQUE])


@query("dq_unique", with_ctes([src for src, _, _ in _UNIQUE_CHECKS],
                              " UNION ALL ".join(_dup_sql(src, m, k) for src, m, k in _UNIQUE_CHECKS)))
def dq_unique(spark, sf):
    """One row per duplicated key value, over the staging keys and the
    source's unique constraints."""
    return quality.unique_keys(_w(spark, sf).pin("transactions"))


_NN = _STAGING_KEYS + [("fact_transactions", "amount")]


@query("dq_not_null", with_ctes([m for m, _ in _NN] + ["raw_transactions"], " UNION ALL ".join(
    [f"SELECT 'not_null' AS check_name, '{m}' AS model, '{c}' AS column_name, "
     f"CAST(COUNT(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS failures FROM {m}" for m, c in _NN]
    + [f"SELECT 'not_null', 'transactions', '{c}', CAST(COUNT(*) FILTER (WHERE {c} IS NULL) AS BIGINT) "
       f"FROM raw_transactions" for c in ("txn_id", "initiated_at", "client_id", "merchant_id", "currency")])))
def dq_not_null(spark, sf):
    checks = [quality.rule(m, quality.not_null(c)) for m, c in _NN]
    checks += [quality.rule("transactions", quality.not_null(c)) for c in ("txn_id", "initiated_at", "client_id", "merchant_id", "currency")]
    return quality.compiled(_w(spark, sf).pin("transactions"), checks).report()


@query("dq_accepted_range", with_ctes(["fact_transactions", "raw_transactions"], """
SELECT 'accepted_range' AS check_name, 'fact_transactions' AS model, 'amount' AS column_name,
  CAST(COUNT(*) FILTER (WHERE amount < 0) AS BIGINT) AS failures FROM fact_transactions
UNION ALL
SELECT 'accepted_range', 'transactions', 'amount', CAST(COUNT(*) FILTER (WHERE amount < 0) AS BIGINT)
FROM raw_transactions"""))
def dq_accepted_range(spark, sf):
    w = _w(spark, sf)
    return quality.column_checks(w.fact_transactions, "fact_transactions",
                                 [quality.accepted_range("amount", min_value=0)]).unionByName(
        quality.column_checks(w.raw.transactions, "transactions",
                              [quality.accepted_range("amount", min_value=0)]))


def _fk_sql() -> tuple[list[str], str]:
    deps, parts = set(), []
    for child, col, parent, pkey in S.FOREIGN_KEYS:
        c = "settlement_batches" if child == "settlement_batches" else "raw_" + child
        deps.update([c, "raw_" + parent])
        parts.append(f"SELECT '{child}' AS child_table, '{col}' AS child_column, '{parent}' AS parent_table, "
                     f"'{pkey}' AS parent_column, COUNT(*) AS orphans FROM {c} WHERE {col} IS NOT NULL AND "
                     f"{col} NOT IN (SELECT {pkey} FROM raw_{parent} WHERE {pkey} IS NOT NULL)")
    return sorted(deps), " UNION ALL ".join(parts)


def _dq_report_sql() -> str:
    parts = []
    for m, k in _STAGING_KEYS:
        parts.append(f"SELECT 'unique' AS check_name, '{m}' AS model, '{k}' AS column_name, "
                     f"(SELECT COUNT(*) FROM (SELECT {k} FROM {m} WHERE {k} IS NOT NULL GROUP BY {k} "
                     f"HAVING COUNT(*) > 1)) AS failures")
        parts.append(f"SELECT 'not_null', '{m}', '{k}', (SELECT COUNT(*) FROM {m} WHERE {k} IS NULL)")
    parts.append("SELECT 'not_null', 'fact_transactions', 'amount', "
                 "(SELECT COUNT(*) FROM fact_transactions WHERE amount IS NULL)")
    parts.append("SELECT 'accepted_range', 'fact_transactions', 'amount', "
                 "(SELECT COUNT(*) FROM fact_transactions WHERE amount < 0)")
    for t, keys in quality.SOURCE_UNIQUE:
        nn = " AND ".join(f"{k} IS NOT NULL" for k in keys)
        parts.append(f"SELECT 'unique', '{t}', '{','.join(keys)}', (SELECT COUNT(*) FROM (SELECT 1 FROM {_source(t)} "
                     f"WHERE {nn} GROUP BY {', '.join(keys)} HAVING COUNT(*) > 1))")
    chans = ", ".join(f"'{c}'" for c in S.CHANNELS)
    curs = ", ".join(f"'{c}'" for c in S.CURRENCIES)
    for name, col, pred in [("not_null", "txn_id", "txn_id IS NULL"),
                            ("not_null", "initiated_at", "initiated_at IS NULL"),
                            ("accepted_range", "amount", "amount < 0"),
                            ("accepted_values", "channel", f"channel IS NOT NULL AND channel NOT IN ({chans})"),
                            ("accepted_values", "currency", f"currency IS NOT NULL AND currency NOT IN ({curs})")]:
        parts.append(f"SELECT '{name}', 'transactions', '{col}', (SELECT COUNT(*) FROM raw_transactions "
                     f"WHERE {pred})")
    states = ", ".join(f"'{s}'" for s in S.BATCH_STATUSES)
    parts.append("SELECT 'accepted_values', 'settlement_batches', 'status', (SELECT COUNT(*) FROM settlement_batches "
                 f"WHERE status IS NOT NULL AND status NOT IN ({states}))")
    return "SELECT check_name, model, column_name, CAST(failures AS BIGINT) AS failures FROM (" + \
        " UNION ALL ".join(parts) + ")"


@query("dq_report", with_ctes([m for m, _ in _STAGING_KEYS] + ["fact_transactions"]
                              + sorted({_source(t) for t, _ in quality.SOURCE_UNIQUE}), _dq_report_sql()))
def dq_report(spark, sf):
    """Every declared and source check in one report; ``quality.gate``
    raises on it when a declared check fails."""
    return quality.dq_report(_w(spark, sf).pin("transactions"))


_LOOKUPS = ["countries", "transaction_types", "transaction_statuses", "card_networks", "merchant_categories",
            "merchants", "pos_terminals", "clients", "payment_cards"]


@query("dq_non_empty", with_ctes(["raw_" + t for t in _LOOKUPS], " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, EXISTS (SELECT 1 FROM raw_{t}) AS has_rows" for t in _LOOKUPS)))
def dq_non_empty(spark, sf):
    raw = _w(spark, sf).raw
    return quality.non_empty({t: getattr(raw, t) for t in _LOOKUPS})


@query("dq_accepted_values", with_ctes(["raw_transactions", "settlement_batches"], f"""
SELECT 'transactions' AS model, 'channel' AS column_name, channel AS value, COUNT(*) AS failures
FROM raw_transactions WHERE channel IS NOT NULL AND channel NOT IN ({", ".join(f"'{c}'" for c in S.CHANNELS)})
GROUP BY channel
UNION ALL
SELECT 'transactions', 'currency', currency, COUNT(*) FROM raw_transactions
WHERE currency IS NOT NULL AND currency NOT IN ({", ".join(f"'{c}'" for c in S.CURRENCIES)}) GROUP BY currency
UNION ALL
SELECT 'settlement_batches', 'status', status, COUNT(*) FROM settlement_batches
WHERE status IS NOT NULL AND status NOT IN ({", ".join(f"'{c}'" for c in S.BATCH_STATUSES)}) GROUP BY status"""))
def dq_accepted_values(spark, sf):
    """Values outside the three declared enumerations, with their counts."""
    w = _w(spark, sf)
    return quality.bad_values(w.raw.transactions, "transactions", {"channel": S.CHANNELS, "currency": S.CURRENCIES}).unionByName(
        quality.bad_values(w.settlement_batches, "settlement_batches", {"status": S.BATCH_STATUSES}))


@query("fill_defaults", with_ctes(["raw_transactions"], """
SELECT txn_id, COALESCE(currency, 'USD') AS currency, COALESCE(fee, CAST(0 AS DECIMAL(10,2))) AS fee,
  COALESCE(is_recurring, 0) AS is_recurring, COALESCE(is_international, 0) AS is_international,
  COALESCE(is_flagged, 0) AS is_flagged
FROM raw_transactions"""))
def fill_defaults(spark, sf):
    t = _w(spark, sf).raw.transactions.select("txn_id", "currency", "fee", "is_recurring",
                                              "is_international", "is_flagged")
    return quality.fill_defaults(t, S.COLUMN_DEFAULTS["transactions"])


@query("fill_defaults_clients", with_ctes(["raw_clients"], """
SELECT client_id, registered_at, COALESCE(risk_score, 10) AS risk_score, COALESCE(is_active, 1) AS is_active FROM raw_clients"""))
def fill_defaults_clients(spark, sf):
    c = _w(spark, sf).raw.clients.select("client_id", "registered_at", "risk_score", "is_active")
    return quality.fill_defaults(c, S.COLUMN_DEFAULTS["clients"])


_ROW_RULES = [
    ("auth_code_iff_approved", "auth_code", "(auth_code IS NOT NULL) <> (status_id = 1)"),
    ("reason_iff_declined_or_failed", "failure_reason", "(failure_reason IS NOT NULL) <> (status_id IN (2, 5))"),
    ("settled_iff_settled", "settled_at", "(settled_at IS NOT NULL) <> (status_id = 6)"),
    ("settled_1_to_3_days", "settled_at",
     "COALESCE(NOT (date_diff('day', CAST(initiated_at AS DATE), settled_at) BETWEEN 1 AND 3), false)"),
    ("device_only_online", "device_id", "device_id IS NOT NULL AND channel NOT IN ('ONLINE', 'MOBILE')"),
    ("ip_iff_online", "ip_address", "(ip_address IS NOT NULL) <> (channel IN ('ONLINE', 'MOBILE'))"),
    ("processed_1_to_8_s", "processed_at", "COALESCE(NOT (epoch(processed_at) - epoch(initiated_at) BETWEEN 1 AND 8), false)"),
    ("fee_in_band", "fee", "COALESCE(NOT (CAST(fee AS DOUBLE) BETWEEN abs(CAST(amount AS DOUBLE)) * 0.015 + 0.10 "
                           "AND abs(CAST(amount AS DOUBLE)) * 0.03 + 0.50), false)"),
    ("net_is_amount_minus_fee", "net_amount", "COALESCE(net_amount <> amount - fee, false)"),
]


@query("dq_row_rules", with_ctes(["raw_transactions"], " UNION ALL ".join(
    f"SELECT '{name}' AS check_name, 'transactions' AS model, '{col}' AS column_name, "
    f"COUNT(*) FILTER (WHERE {fails}) AS failures FROM raw_transactions" for name, col, fails in _ROW_RULES)))
def dq_row_rules(spark, sf):
    return quality.row_rules(_w(spark, sf).raw.transactions).select("check_name", "model", "column_name", "failures")


@query("dq_one_default_card", with_ctes(["raw_payment_cards"], """
SELECT client_id, CAST(SUM(is_default) AS BIGINT) AS default_cards FROM raw_payment_cards
GROUP BY client_id HAVING SUM(is_default) <> 1"""))
def dq_one_default_card(spark, sf):
    return quality.default_card_violations(_w(spark, sf).raw.payment_cards)


@query("fk_orphans", with_ctes(*_fk_sql()))
def fk_orphans(spark, sf):
    """Orphan child rows per declared foreign key."""
    w = _w(spark, sf).pin("transactions")
    return quality.fk_orphans(w.raw, tables={"settlement_batches": w.settlement_batches})


# ===================================================================== recon

@query("settlement_batches", with_ctes(["settlement_batches"], "SELECT * FROM settlement_batches"))
def settlement_batches(spark, sf):
    return _w(spark, sf).settlement_batches


register("refunds_latest", ["raw_refunds"], latest_sql(
    "refunds_latest", "raw_refunds", "refund_id", "created_at DESC NULLS FIRST",
    ["refund_id", "original_txn_id", "reference", "amount", "reason", "status_id", "initiated_at",
     "resolved_at", "created_at"]))


@query("refund_net", with_ctes(["refunds_latest", "current_transactions"], """
SELECT r.refund_id, r.original_txn_id, r.amount AS refund_amount, ABS(t.amount) AS original_amount,
  CASE WHEN r.amount < ABS(t.amount) THEN 'partial' ELSE 'full' END AS refund_type,
  ABS(t.amount) - CAST(r.refunded AS DECIMAL(14,2)) AS net_after_refund,
  date_diff('hour', r.initiated_at, r.resolved_at) AS hours_to_resolve
FROM (SELECT *, SUM(CASE WHEN status_id IS DISTINCT FROM 4 THEN COALESCE(amount, 0) ELSE 0 END)
             OVER (PARTITION BY original_txn_id) AS refunded FROM refunds_latest) r
JOIN current_transactions t ON r.original_txn_id = t.txn_id"""))
def refund_net(spark, sf):
    w = _w(spark, sf)
    return recon.refund_net(w.raw.refunds, w.current("amount"))


@query("approved_sales", with_ctes(["current_status"], """
SELECT CAST(initiated_at AS DATE) AS transaction_date, COALESCE(merchant_id, -1) AS merchant_id,
  COALESCE(UPPER(TRIM(currency)), 'EGP') AS currency, COUNT(txn_id) AS total_transaction_count,
  SUM(ABS(amount)) AS daily_total_amount,
  ROUND(CAST(CAST(SUM(ABS(amount)) AS DOUBLE) / COUNT(amount) AS DECIMAL(18,6)), 2) AS avg_transaction_value
FROM current_status WHERE status_code IN ('APPROVED','SETTLED') AND initiated_at IS NOT NULL
GROUP BY 1, 2, 3"""))
def approved_sales(spark, sf):
    w = _w(spark, sf)
    return recon.approved_sales(w.current("status_id", "initiated_at", "merchant_id", "currency", "amount"), w.raw.status_lookup)


@query("status_mix", with_ctes(["current_status"], """, mx AS (
  SELECT 'status' AS dimension, status_code AS value, COUNT(*) AS n FROM current_status GROUP BY 2
  UNION ALL SELECT 'channel', channel, COUNT(*) FROM current_status GROUP BY 2
  UNION ALL SELECT 'currency', COALESCE(UPPER(TRIM(currency)), 'EGP'), COUNT(*) FROM current_status GROUP BY 2)
SELECT dimension, value, n, CAST(floor(n * 10000 / SUM(n) OVER (PARTITION BY dimension)) AS BIGINT) AS share_bp
FROM mx"""))
def status_mix(spark, sf):
    w = _w(spark, sf)
    return recon.mix(w.current("status_id", "channel", "currency"), w.raw.status_lookup)


register("dim_merchants_one", ["dim_merchants"], latest_sql(
    "dim_merchants_one", "dim_merchants", "merchant_id", "merchant_onboarded_at DESC NULLS FIRST",
    ["merchant_id", "merchant_name", "merchant_category_code", "merchant_category_group",
     "merchant_onboarded_at"]))


@query("star_sales", with_ctes(["fct_daily_merchant_sales", "dim_merchants_one", "dim_date"], """
SELECT f.transaction_date, f.merchant_id, COALESCE(m.merchant_name, 'Unknown Merchant') AS merchant_name,
  COALESCE(m.merchant_category_group, 'OTHER') AS merchant_category_group, d.day_type,
  d.month_name, d.quarter, f.currency, f.total_transaction_count, f.daily_total_amount
FROM fct_daily_merchant_sales f
LEFT JOIN dim_merchants_one m ON f.merchant_id = m.merchant_id
LEFT JOIN dim_date d ON f.transaction_date = d.date_key"""))
def star_sales(spark, sf):
    w = _w(spark, sf)
    return recon.star_sales(w.fct_daily_merchant_sales, w.dim_merchants, w.dim_date)


@query("sales_by_day_type", with_ctes(["fact_transactions", "dim_date"], """
SELECT d.day_type, d.quarter, COUNT(f.transaction_id) AS n_txns, SUM(f.amount) AS total_amount
FROM fact_transactions f LEFT JOIN dim_date d ON f.date_key = d.date_key GROUP BY 1, 2"""))
def sales_by_day_type(spark, sf):
    w = _w(spark, sf)
    return recon.sales_by_day_type(w.fact_transactions, w.dim_date)


@query("merchant_from_terminal", with_ctes(["current_transactions", "raw_pos_terminals"], """
SELECT t.txn_id, t.pos_id, t.merchant_id, COALESCE(p.merchant_id, t.merchant_id) AS resolved_merchant_id
FROM current_transactions t LEFT JOIN raw_pos_terminals p ON t.pos_id = p.pos_id"""))
def merchant_from_terminal(spark, sf):
    w = _w(spark, sf)
    return recon.merchant_from_terminal(w.current("pos_id", "merchant_id"), w.raw.pos_terminals)


@query("status_lookup", with_ctes(["current_status"], """
SELECT txn_id, status_id, status_code FROM current_status"""))
def status_lookup(spark, sf):
    w = _w(spark, sf)
    return recon.with_status(w.current("status_id"), w.raw.status_lookup)


@query("cards_per_client", with_ctes(["raw_payment_cards"], """
SELECT client_id, card_id, COUNT(*) OVER (PARTITION BY client_id) AS n_cards FROM raw_payment_cards"""))
def cards_per_client(spark, sf):
    return recon.cards_per_client(_w(spark, sf).raw.payment_cards)


@query("event_rates", with_ctes(["live_transactions"], """
SELECT date_trunc('hour', initiated_at) AS window_start, channel, COUNT(*) AS n_events
FROM live_transactions GROUP BY 1, 2"""))
def event_rates(spark, sf):
    return recon.event_rates(_w(spark, sf).raw.live_transactions)


@query("initcap_names", with_ctes(["raw_merchants", "raw_countries"], f"""
SELECT 'merchants' AS source, trade_name AS raw_name, {initcap('trade_name')} AS initcap_name FROM raw_merchants
UNION ALL
SELECT 'countries', name, {initcap('TRIM(name)')} FROM raw_countries"""))
def initcap_names(spark, sf):
    from paylake.functions import pg_initcap
    raw = _w(spark, sf).raw
    m = raw.merchants.select(F.lit("merchants").alias("source"), F.col("trade_name").alias("raw_name"),
                             pg_initcap(F.col("trade_name")).alias("initcap_name"))
    c = raw.countries.select(F.lit("countries").alias("source"), F.col("name").alias("raw_name"),
                             pg_initcap(F.trim("name")).alias("initcap_name"))
    return m.unionByName(c)


@query("risk_category", with_ctes(["stg_clients"], """
SELECT client_id, risk_score, CASE WHEN risk_score IS NULL THEN 'Unrated' WHEN risk_score > 80 THEN 'High Risk'
  WHEN risk_score > 50 THEN 'Medium Risk' ELSE 'Low Risk' END AS risk_category FROM stg_clients"""))
def risk_category(spark, sf):
    from paylake.operators.marts import risk_category as rc
    c = _w(spark, sf).stg_clients
    return c.select("client_id", "risk_score", rc(F.col("risk_score")).alias("risk_category"))


@query("surrogate_key", with_ctes(["stg_countries"], f"""
SELECT country_id, country_name, md5(COALESCE(CAST(country_id AS VARCHAR), '{S.SURROGATE_NULL}') || '-' ||
  COALESCE(country_name, '{S.SURROGATE_NULL}')) AS location_key FROM stg_countries"""))
def surrogate_key(spark, sf):
    from paylake.functions import surrogate_key as sk
    c = _w(spark, sf).stg_countries
    return c.select("country_id", "country_name", sk(F.col("country_id"), F.col("country_name")).alias("location_key"))


# ===================================================================== fraud

def _live(spark, sf):
    return _w(spark, sf).raw.live_transactions


def _range_count(width_s: int, where: str = "TRUE", extra: str = "", source: str = "live_transactions") -> str:
    return f"""
  lw AS (
    SELECT *, COUNT(*) OVER (PARTITION BY client_id ORDER BY epoch_us(initiated_at)
                             RANGE BETWEEN {width_s * 1_000_000} PRECEDING AND CURRENT ROW) AS n_in_window{extra}
    FROM {source} WHERE client_id IS NOT NULL AND ({where}))"""


@query("fraud_velocity_burst", with_ctes(["live_transactions"], "," + _range_count(600) + """
SELECT txn_id, client_id, initiated_at, n_in_window FROM lw WHERE n_in_window >= 5"""))
def fraud_velocity_burst(spark, sf):
    return fraud.velocity_burst(_live(spark, sf))


@query("fraud_card_testing", with_ctes(["live_transactions"], "," + _range_count(
    900, "channel = 'ONLINE' AND amount BETWEEN 0.01 AND 1.99") + """
SELECT txn_id, client_id, amount, initiated_at, n_in_window FROM lw WHERE n_in_window >= 10"""))
def fraud_card_testing(spark, sf):
    return fraud.card_testing(_live(spark, sf))


@query("fraud_high_value", with_ctes(["live_transactions"], """
SELECT txn_id, client_id, amount, currency, channel, initiated_at FROM live_transactions
WHERE amount >= 3000 AND channel IN ('ONLINE', 'MOBILE') AND is_international = 1 AND currency <> 'USD'"""))
def fraud_high_value(spark, sf):
    return fraud.high_value(_live(spark, sf))


@query("fraud_night_owl", with_ctes(["live_transactions"], """
SELECT client_id, CAST(initiated_at AS DATE) AS night, COUNT(*) AS n_txns, SUM(amount) AS total_amount
FROM live_transactions
WHERE hour(initiated_at) BETWEEN 1 AND 4 AND channel IN ('ONLINE', 'MOBILE') AND amount BETWEEN 100 AND 3000
GROUP BY 1, 2 HAVING COUNT(*) >= 2"""))
def fraud_night_owl(spark, sf):
    return fraud.night_owl(_live(spark, sf))


@query("fraud_international_spree", with_ctes(["live_transactions"], "," + _range_count(
    135 * 60, "currency <> 'USD'",
    extra=", CAST(len(list_distinct(list(currency) OVER (PARTITION BY client_id ORDER BY epoch_us(initiated_at) "
          "RANGE BETWEEN 8100000000 PRECEDING AND CURRENT ROW))) AS INTEGER) AS n_currencies") + """
SELECT txn_id, client_id, initiated_at, n_in_window, n_currencies FROM lw
WHERE n_in_window >= 3 AND n_currencies >= 2"""))
def fraud_international_spree(spark, sf):
    return fraud.international_spree(_live(spark, sf))


@query("fraud_account_takeover", with_ctes(["live_transactions"], """
, fd AS (SELECT client_id, device_id, MIN(initiated_at) AS device_first FROM live_transactions GROUP BY 1, 2),
fc AS (SELECT client_id, MIN(initiated_at) AS client_first FROM live_transactions GROUP BY 1)
SELECT t.txn_id, t.client_id, t.device_id, t.amount, t.currency, t.initiated_at
FROM live_transactions t JOIN fd ON t.client_id = fd.client_id AND t.device_id = fd.device_id
JOIN fc ON t.client_id = fc.client_id
WHERE t.channel = 'ONLINE' AND t.currency <> 'USD' AND t.amount >= 500 AND t.device_id IS NOT NULL
  AND t.initiated_at = fd.device_first AND t.initiated_at > fc.client_first"""))
def fraud_account_takeover(spark, sf):
    return fraud.account_takeover(_live(spark, sf))


@query("flagged_transactions", with_ctes(["current_transactions"], """
SELECT txn_id, client_id, amount, channel, is_international FROM current_transactions WHERE is_flagged = 1"""))
def flagged_transactions(spark, sf):
    return _w(spark, sf).flagged.select("txn_id", "client_id", "amount", "channel", "is_international")


def _rules_sql() -> str:
    from paylake.plans.oracle_base import _rules
    return _rules("abs(amount)", "channel", "is_international")


@query("fraud_rule_tags", with_ctes(["current_transactions"], f"""
SELECT txn_id, unnest({_rules_sql()}) AS rule FROM current_transactions WHERE is_flagged = 1"""))
def fraud_rule_tags(spark, sf):
    return fraud.rule_tags(_w(spark, sf).flagged)


@query("alert_scores", with_ctes(["current_transactions"], """
SELECT txn_id, ABS(amount) AS amount, CAST(least(100, CASE WHEN ABS(amount) < 1000 THEN 60
  WHEN ABS(amount) < 3000 THEN 75 ELSE 90 END) AS INTEGER) AS base_risk
FROM current_transactions WHERE is_flagged = 1"""))
def alert_scores(spark, sf):
    return fraud.base_scores(_w(spark, sf).flagged)


register("alerts_latest", ["raw_fraud_alerts"], latest_sql(
    "alerts_latest", "raw_fraud_alerts", "alert_id", "created_at DESC NULLS FIRST",
    ["alert_id", "txn_id", "rule_triggered", "risk_score", "is_confirmed", "reviewed_by", "reviewed_at",
     "created_at"]))


def _alerts(w):
    from paylake.functions import latest_per_key
    return latest_per_key(w.raw.fraud_alerts, ["alert_id"], [F.col("created_at").desc_nulls_first()])


@query("alert_review_funnel", with_ctes(["alerts_latest"], """
SELECT rule_triggered, COUNT(*) AS n_alerts, COUNT(reviewed_at) AS n_reviewed,
  CAST(SUM(COALESCE(is_confirmed, 0)) AS BIGINT) AS n_confirmed,
  COUNT(reviewed_at) * 10000 // COUNT(*) AS reviewed_bp,
  CAST(SUM(COALESCE(is_confirmed, 0)) AS BIGINT) * 10000 // NULLIF(COUNT(reviewed_at), 0) AS confirmed_bp
FROM alerts_latest GROUP BY 1"""))
def alert_review_funnel(spark, sf):
    return fraud.review_funnel(_alerts(_w(spark, sf)))


@query("fraud_summary", with_ctes(["current_transactions", "alerts_latest"], """
, t AS (SELECT COUNT(*) AS n_txns, CAST(SUM(CASE WHEN is_flagged = 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_flagged
        FROM current_transactions),
a AS (SELECT COUNT(*) AS n_alerts, COUNT(DISTINCT txn_id) AS n_alerted_txns FROM alerts_latest)
SELECT n_txns, n_flagged, n_flagged * 10000 // n_txns AS flagged_bp, n_alerts, n_alerted_txns,
  n_alerts * 100 // n_alerted_txns AS alerts_per_txn_x100 FROM t, a"""))
def fraud_summary(spark, sf):
    w = _w(spark, sf)
    return fraud.summary(w.current("is_flagged"), _alerts(w))


@query("alerted_transactions", with_ctes(["alerts_latest", "current_transactions"], """
SELECT a.alert_id, a.txn_id, a.rule_triggered, a.risk_score, t.amount, t.channel
FROM alerts_latest a JOIN current_transactions t ON a.txn_id = t.txn_id"""))
def alerted_transactions(spark, sf):
    w = _w(spark, sf)
    t = w.current("amount", "channel")
    return _alerts(w).select("alert_id", "txn_id", "rule_triggered", "risk_score").join(t, "txn_id")
