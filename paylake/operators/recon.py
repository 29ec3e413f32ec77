"""Reconciliation and reporting: current state, settlements, refunds,
star joins, mixes and lookups."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paylake import schemas as S
from paylake.functions import clean_code, latest_columns, latest_per_key

APPROVED_CODES = ("APPROVED", "SETTLED")
REVERSED = 4


def current_transactions(raw_txn: DataFrame) -> DataFrame:
    """Latest version of every transaction id (NULL ``created_at`` first,
    then every other column as a deterministic tie-break)."""
    return latest_per_key(raw_txn.filter(F.col("txn_id").isNotNull()), ["txn_id"],
                          [F.col("created_at").desc_nulls_first()])


def current_columns(raw_txn: DataFrame, *columns: str, among: Callable[[Callable[..., DataFrame]], DataFrame] | None = None) -> DataFrame:
    """:func:`current_transactions` with ``txn_id`` and ``columns`` alone; whole rows are not shuffled.
    ``among`` is that of :func:`latest_columns` for ``raw_txn``."""
    known = F.col("txn_id").isNotNull()
    return latest_columns(raw_txn.filter(known), ["txn_id"], [F.col("created_at").desc_nulls_first()], columns,
                          (lambda only: among(only).filter(known)) if among else None)


def with_status(txn: DataFrame, statuses: DataFrame) -> DataFrame:
    """Attach the status code. The status table is a fixed lookup (seven
    rows), so broadcasting it is size-safe at any data volume."""
    return txn.join(F.broadcast(statuses.select("status_id", F.col("code").alias("status_code"))),
                    "status_id", "left")


def settlement_batches(current: DataFrame, statuses: DataFrame, as_of: str = S.CALENDAR_END) -> DataFrame:
    """Per merchant and day of approved/settled transactions: count, gross,
    fees, net = gross - fees; SETTLED when more than 2 days before ``as_of``
    (settled at 22:00), PENDING otherwise (R9).

    One partial+final hash aggregate keyed by (merchant, day)."""
    ok = with_status(current, statuses).filter(
        F.col("status_code").isin(*APPROVED_CODES) & F.col("merchant_id").isNotNull()
        & F.col("initiated_at").isNotNull())
    g = (ok.groupBy("merchant_id", F.col("initiated_at").cast("date").alias("batch_date"))
           .agg(F.count("*").alias("txn_count"),
                F.sum(F.abs("amount")).cast("decimal(16,2)").alias("gross_amount"),
                F.sum("fee").cast("decimal(14,2)").alias("total_fees")))
    settled = F.datediff(F.lit(as_of).cast("date"), F.col("batch_date")) > 2
    return g.select(
        (F.col("merchant_id") * 100000 + F.datediff("batch_date", F.lit("2000-01-01").cast("date")))
        .alias("batch_id"),
        "merchant_id", "batch_date", "txn_count", "gross_amount", "total_fees",
        (F.col("gross_amount") - F.col("total_fees")).cast("decimal(16,2)").alias("net_payout"),
        F.lit("USD").alias("currency"),
        F.when(settled, "SETTLED").otherwise("PENDING").alias("status"),
        F.when(settled, F.timestamp_add("HOUR", F.lit(22), F.col("batch_date").cast("timestamp_ntz")))
         .alias("settled_at"),
        F.timestamp_add("HOUR", F.lit(24), F.col("batch_date").cast("timestamp_ntz")).alias("created_at"))


def refund_net(refunds: DataFrame, current: DataFrame) -> DataFrame:
    """Refunds joined to their original transaction: full or partial, the net kept
    after all of its refunds, and hours to resolve (J6, R10). Reversed refunds (status 4)
    take nothing from the net; the other refunds of one transaction are summed first."""
    r = latest_per_key(refunds, ["refund_id"], [F.col("created_at").desc_nulls_first()])
    counts = F.when(F.coalesce("status_id", F.lit(0)) != REVERSED, F.coalesce("amount", F.lit(0))).otherwise(0)
    r = r.withColumn("refunded", F.sum(counts).over(Window.partitionBy("original_txn_id")).cast("decimal(14,2)"))
    t = current.select(F.col("txn_id").alias("original_txn_id"), F.abs("amount").alias("original_amount"))
    j = r.join(t, "original_txn_id")
    return j.select(
        "refund_id", "original_txn_id", F.col("amount").alias("refund_amount"), "original_amount",
        F.when(F.col("amount") < F.col("original_amount"), "partial").otherwise("full").alias("refund_type"),
        (F.col("original_amount") - F.col("refunded")).alias("net_after_refund"),
        F.timestamp_diff("HOUR", F.col("initiated_at"), F.col("resolved_at")).alias("hours_to_resolve"))


def approved_sales(current: DataFrame, statuses: DataFrame) -> DataFrame:
    """Daily sales counting approved and settled transactions only (R11,
    the answer to D2)."""
    ok = with_status(current, statuses).filter(
        F.col("status_code").isin(*APPROVED_CODES) & F.col("initiated_at").isNotNull())
    rows = ok.select(F.col("initiated_at").cast("date").alias("transaction_date"),
                     F.coalesce("merchant_id", F.lit(S.UNKNOWN_ID).cast("bigint")).alias("merchant_id"),
                     clean_code(F.col("currency"), S.DEFAULT_CURRENCY).alias("currency"),
                     F.abs("amount").alias("amount"), "txn_id")
    return (rows.groupBy("transaction_date", "merchant_id", "currency")
                .agg(F.count("txn_id").alias("total_transaction_count"),
                     F.sum("amount").cast("decimal(38,2)").alias("daily_total_amount"),
                     F.round(F.avg("amount"), 2).cast("decimal(18,2)").alias("avg_transaction_value")))


def mix(current: DataFrame, statuses: DataFrame) -> DataFrame:
    """Counts and shares (basis points) by status, channel and currency
    (R13). The share's total comes from a window over the grouped rows --
    at most a few dozen rows per dimension."""
    t = with_status(current, statuses).select(
        "status_code", "channel", clean_code(F.col("currency"), S.DEFAULT_CURRENCY).alias("currency"))
    stacked = t.select(F.explode(F.array(
        F.struct(F.lit("status").alias("dimension"), F.col("status_code").alias("value")),
        F.struct(F.lit("channel").alias("dimension"), F.col("channel").alias("value")),
        F.struct(F.lit("currency").alias("dimension"), F.col("currency").alias("value")))).alias("d"))
    g = stacked.groupBy("d.dimension", "d.value").agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy("dimension"))
    return g.select("dimension", "value", "n", F.floor(F.col("n") * 10000 / total).cast("bigint").alias("share_bp"))


def dedup_dim(dim: DataFrame, key: str, order_col: str) -> DataFrame:
    """One row per key of a dimension that may repeat keys (D3)."""
    return latest_per_key(dim, [key], [F.col(order_col).desc_nulls_first()])


def star_sales(daily: DataFrame, dim_merchants: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Daily merchant sales with merchant and calendar attributes.

    Left joins keep every fact row; null keys were mapped to -1 and meet the
    unknown member, and so do keys that the dimension does not have. The merchant dimension is deduplicated first so repeated
    merchant rows cannot multiply facts. Both dimensions grow with the data
    (merchants, days of the span), so neither carries a broadcast hint: AQE
    broadcasts a side only after measuring it under the threshold."""
    m = dedup_dim(dim_merchants, "merchant_id", "merchant_onboarded_at").select(
        "merchant_id", "merchant_name", "merchant_category_group")
    d = dim_date.select(F.col("date_key").alias("transaction_date"), "day_type", "month_name", "quarter")
    return (daily.join(m, "merchant_id", "left").join(d, "transaction_date", "left")
                 .select("transaction_date", "merchant_id",
                         F.coalesce("merchant_name", F.lit("Unknown Merchant")).alias("merchant_name"),
                         F.coalesce("merchant_category_group", F.lit("OTHER")).alias("merchant_category_group"),
                         "day_type", "month_name", "quarter", "currency", "total_transaction_count",
                         "daily_total_amount"))


def sales_by_day_type(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    d = dim_date.select("date_key", "day_type", "quarter")
    return (fact.join(d, "date_key", "left")
                .groupBy("day_type", "quarter")
                .agg(F.count("transaction_id").alias("n_txns"),
                     F.sum("amount").cast("decimal(38,2)").alias("total_amount")))


def merchant_from_terminal(current: DataFrame, terminals: DataFrame) -> DataFrame:
    """The merchant of a transaction is its terminal's merchant; without a
    terminal, its own merchant id (J3)."""
    pos = terminals.select("pos_id", F.col("merchant_id").alias("terminal_merchant_id"))
    rows = current.select("txn_id", "pos_id", "merchant_id")
    # without a terminal there is nothing to join: such rows (a third of all) stay out of the shuffle
    away = rows.filter(F.col("pos_id").isNull()).withColumn("terminal_merchant_id", F.lit(None).cast("bigint"))
    found = rows.filter(F.col("pos_id").isNotNull()).join(pos, "pos_id", "left").select(away.columns)
    return found.unionByName(away).select("txn_id", "pos_id", "merchant_id",
                                          F.coalesce("terminal_merchant_id", "merchant_id").alias("resolved_merchant_id"))


def cards_per_client(cards: DataFrame) -> DataFrame:
    """Every client's cards (A4), one row each with the client's number of cards: the
    same shape for any number of cards, and no list that grows with a client."""
    n = cards.groupBy("client_id").agg(F.count("*").alias("n_cards"))
    n = n.withColumnRenamed("client_id", "_client")
    return (cards.select("client_id", "card_id").join(n, F.col("client_id").eqNullSafe(F.col("_client")))
                 .select("client_id", "card_id", "n_cards"))


def event_rates(live: DataFrame, every: str = "1 hour") -> DataFrame:
    """Transactions per tumbling window and channel."""
    return (live.groupBy(F.window(F.col("initiated_at"), every).alias("w"), "channel")
                .agg(F.count("*").alias("n_events"))
                .select(F.col("w.start").alias("window_start"), "channel", "n_events"))
