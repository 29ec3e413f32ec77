"""Queries of the incremental flows: even extracts, cast quarantine, landed fields beyond the
schema, settlements by changed days, facts and late dimension rows."""
from __future__ import annotations

from pyspark.sql import functions as F

from paylake import schemas as S
from paylake.operators import extract, incremental, ingest, staging
from paylake.plans.oracle_base import with_ctes
from paylake.plans.queries_ops import CUTOFF, TS_MS
from paylake.plans.queries_stream import _scratch
from paylake.plans.registry import query, warehouse
from paylake.streaming import landing

RANGES = 16


@query("range_extract", with_ctes(["raw_transactions"], f"""
SELECT COUNT(*) AS n_rows, {RANGES} AS n_ranges, true AS even FROM raw_transactions"""))
def range_extract(spark, sf):
    """A full extract in key ranges of even size, with one key far off: rows read, ranges, and
    whether no range has over twice the rows of another. Rows without a key are apart."""
    t = warehouse(spark, sf).raw.transactions.select("txn_id")
    t = t.select(F.when(F.col("txn_id") % 1009 == 1, F.col("txn_id") + 10**12).otherwise(F.col("txn_id")).alias("txn_id"))
    parts = extract.by_ranges(t, "txn_id", RANGES).groupBy("key_range").agg(F.count("*").alias("n"))
    keyed = F.col("key_range") >= 0
    n = F.when(keyed, F.col("n"))
    return parts.agg(F.sum("n").alias("n_rows"), F.sum(keyed.cast("int")).cast("int").alias("n_ranges"),
                     (F.max(n) <= 2 * F.min(n)).alias("even"))


def _as_text(w):
    """Transactions as text columns, some values not of their type."""
    t = w.raw.transactions.select(*[F.col(c).cast("string").alias(c) for c in (
        "txn_id", "client_id", "merchant_id", "amount", "currency", "initiated_at", "created_at")])
    k = F.coalesce(t.txn_id.cast("bigint"), F.lit(0))
    return (t.withColumn("initiated_at", F.when(k % 61 == 7, "not a time").when(k % 61 == 9, "2026-02-30 10:00:00").otherwise(t.initiated_at))
             .withColumn("amount", F.when(k % 67 == 3, "twelve").otherwise(t.amount)))


def _typed():
    f = {f.name: f for f in S.RAW_SCHEMAS["transactions"].fields}
    return S._s(*[(c, f[c].dataType) for c in ("txn_id", "client_id", "merchant_id", "amount", "currency", "initiated_at", "created_at")])


_BAD = ("COALESCE(txn_id, 0) % 67 = 3", "COALESCE(txn_id, 0) % 61 IN (7, 9)")


@query("cast_quarantine", with_ctes(["raw_transactions"], f"""
SELECT txn_id, 'bad_cast:' || CASE WHEN {_BAD[0]} AND {_BAD[1]} THEN 'amount,initiated_at'
  WHEN {_BAD[0]} THEN 'amount' ELSE 'initiated_at' END AS error_msg
FROM raw_transactions WHERE {_BAD[0]} OR {_BAD[1]}"""))
def cast_quarantine(spark, sf):
    """Rows with a value that cannot be read as its type, with the reason."""
    _, bad = extract.cast_split(_as_text(warehouse(spark, sf)), _typed())
    return bad.select(F.get_json_object("value", "$.txn_id").cast("bigint").alias("txn_id"), "error_msg")


@query("cast_staging", with_ctes(["raw_transactions"], f"""
, good AS (SELECT * FROM raw_transactions WHERE NOT ({_BAD[0]} OR {_BAD[1]}) AND txn_id NOTNULL AND initiated_at NOTNULL)
SELECT txn_id AS transaction_id, COUNT(DISTINCT initiated_at) >= 1 AS staged FROM good GROUP BY txn_id"""))
def cast_staging(spark, sf):
    """The staging model runs over the rows that could be read, whatever the others hold."""
    good, _ = extract.cast_split(_as_text(warehouse(spark, sf)), _typed())
    stg = staging.stg_transactions(good)
    return stg.select("transaction_id", F.col("initiated_at_timestamp").isNotNull().alias("staged"))


@query("reconciled_types", with_ctes(["raw_transactions"], """
SELECT txn_id, client_id, merchant_id, status_id, amount, initiated_at FROM raw_transactions"""))
def reconciled_types(spark, sf):
    """Raw files of two shapes, as a writer that infers types makes them: ids as whole numbers
    where none is null, as floating numbers elsewhere, times as text; read as one table."""
    t = warehouse(spark, sf).raw.transactions.select("txn_id", "client_id", "merchant_id", "status_id", "amount", "initiated_at")
    base = _scratch(spark, "shapes")
    time = F.date_format("initiated_at", "yyyy-MM-dd'T'HH:mm:ss").alias("initiated_at")
    whole = F.col("txn_id").isNotNull() & F.col("client_id").isNotNull() & F.col("merchant_id").isNotNull()
    ids = ("txn_id", "client_id", "merchant_id")
    t.filter(whole).select(*ids, "status_id", F.col("amount").cast("double"), time).write.parquet(base + "/day=01")
    t.filter(~whole).select(*[F.col(c).cast("double").alias(c) for c in ids], F.col("status_id").cast("bigint"),
                            F.col("amount").cast("double"), time).write.parquet(base + "/day=02")
    good, _ = extract.read_reconciled(spark, [base + "/day=01", base + "/day=02"], t.schema)
    return good


@query("landed_clients", with_ctes(["raw_clients"], """
SELECT *, DATE '1950-01-01' + CAST(client_id % 20000 AS INTEGER) AS date_of_birth, client_id || ' Main Street' AS address,
  lpad(CAST(client_id % 100000 AS VARCHAR), 5, '0') AS zip_code, client_id % 7 AS points FROM raw_clients"""))
def landed_clients(spark, sf):
    """Client messages with all columns of the operational table and a field that the schema
    does not know: landed with every column, the unknown field rescued."""
    c = warehouse(spark, sf).raw.clients
    k = F.col("client_id")
    sent = c.select("*", F.date_add(F.lit("1950-01-01").cast("date"), (k % 20000).cast("int")).alias("date_of_birth"),
                    F.concat(k.cast("string"), F.lit(" Main Street")).alias("address"),
                    F.lpad((k % 100000).cast("string"), 5, "0").alias("zip_code"), F.struct((k % 7).alias("points")).alias("loyalty"))
    base = _scratch(spark, "clients")
    landing.publish(ingest.envelope(sent, "clients", "r", TS_MS, "client_id"), base + "/in")
    landing.start_landing(spark, base + "/in", base + "/raw", base + "/dlq", base + "/ckpt",
                          {"clients": S.RAW_SCHEMAS["clients"]}).awaitTermination()
    landed = spark.read.parquet(base + "/raw")
    points = F.try_variant_get(F.col(ingest.RESCUED), "$.loyalty.points", "bigint").alias("points")
    return landed.select(*c.columns, "date_of_birth", "address", "zip_code", points)


@query("settlement_increment", with_ctes(["current_status"], """
, g AS (
  SELECT merchant_id, CAST(initiated_at AS DATE) AS batch_date, COALESCE(upper(trim(currency)), 'USD') AS currency,
    COUNT(*) AS txn_count, CAST(SUM(ABS(amount)) AS DECIMAL(16,2)) AS gross_amount, CAST(SUM(fee) AS DECIMAL(14,2)) AS total_fees
  FROM current_status WHERE status_code IN ('APPROVED','SETTLED') AND merchant_id IS NOT NULL AND initiated_at IS NOT NULL
  GROUP BY 1, 2, 3)
SELECT *, CAST(gross_amount - total_fees AS DECIMAL(16,2)) AS net_payout FROM g"""))
def settlement_increment(spark, sf):
    """Settlements by merchant, day and currency after two runs, the second with the
    transactions created since: equal to those computed at once."""
    w = warehouse(spark, sf).pin("transactions")
    t, out = w.raw.transactions, _scratch(spark, "settled")
    late = F.coalesce(F.col("created_at") > F.lit(CUTOFF).cast("timestamp_ntz"), F.lit(False))
    early = t.filter(~late)
    incremental.settle(early, early, w.raw.status_lookup, out)
    incremental.settle(t, t.filter(late), w.raw.status_lookup, out)
    return incremental.read_settlements(spark, out)


@query("star_rekeyed", with_ctes(["fact_transactions", "dim_clients", "dim_merchants", "dim_location", "stg_clients", "dim_date"], """
SELECT f.transaction_id, f.client_id, f.merchant_id, COALESCE(c.client_id, -1) AS client_key, COALESCE(m.merchant_id, -1) AS merchant_key,
  COALESCE(l.location_key, 'unknown') AS location_key, f.amount, f.currency, d.date_key AS calendar_day, f.date_key
FROM fact_transactions f LEFT JOIN (SELECT DISTINCT client_id FROM dim_clients) c ON f.client_id = c.client_id
LEFT JOIN (SELECT DISTINCT merchant_id FROM dim_merchants) m ON f.merchant_id = m.merchant_id
LEFT JOIN stg_clients h ON f.client_id = h.client_id LEFT JOIN dim_location l ON h.country_id = l.country_id
LEFT JOIN dim_date d ON f.date_key = d.date_key"""))
def star_rekeyed(spark, sf):
    """Facts with client, merchant, location and date keys. A tenth of the merchants come after
    the facts: their rows meet the unknown member first and are moved by the re-key."""
    w = warehouse(spark, sf).pin("transactions")
    dims = {"dim_clients": w.dim_clients, "dim_merchants": w.dim_merchants}
    rest = (w.stg_clients.select("client_id", "country_id"), w.dim_location, w.dim_date)
    early = dims | {"dim_merchants": w.dim_merchants.filter(F.col("merchant_id") % 10 != 3)}
    out = _scratch(spark, "star")
    incremental.write_star(incremental.star_keys(w.fact_transactions, early, *rest), out)
    incremental.rekey(spark, out, dims, *rest)
    return spark.read.parquet(out)
