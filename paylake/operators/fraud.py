"""Fraud-pattern detectors and alert analytics.

The detectors are trailing event-time windows per client, split into (client,
time-bucket) partitions: each row also appears, as a context row, in the next bucket
when it lies within one window width of that bucket's start, so every trailing window
is complete inside its own partition and the result is exact.

Inside a partition the work is linear after one sort, however dense the burst: every
row adds one to a running count at its own time and takes it away again once the
window has passed it. Rows without a client are no client's burst and are set aside.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paylake import schemas as S
from paylake.sources.adapters import alert_score, candidate_rules

ONLINE = ("ONLINE", "MOBILE")
US = 1_000_000


def event_micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def trailing_window(df: DataFrame, key: str, ts: str, width_s: int, distinct: str | None = None,
                    bucket_s: int | None = None) -> DataFrame:
    """Add ``n_in_window``, the rows of ``key`` in ``[ts - width, ts]`` (rows of one time
    count each other), and with ``distinct`` ``n_distinct``, the different values of that column.

    A row counts from its time until ``width`` has passed. For the distinct count a value counts
    from the first of its rows that lie within ``width`` of each other until the last has left.
    """
    bucket_us, width_us = max(bucket_s or 3600, width_s) * US, width_s * US
    base = df.filter(F.col(key).isNotNull() & F.col(ts).isNotNull())
    base = base.withColumn("_us", event_micros(F.col(ts))).withColumn("_b0", F.floor(F.col("_us") / bucket_us))
    near_next = F.col("_us") >= (F.col("_b0") + 1) * bucket_us - width_us
    # one pass: a row near the next bucket is emitted twice, once as context
    rows = (base.withColumn("_b", F.explode(F.when(near_next, F.array("_b0", F.col("_b0") + 1)).otherwise(F.array("_b0"))))
                .withColumn("_ctx", F.col("_b") != F.col("_b0")).drop("_b0"))
    rows = rows.repartition(key, "_b")
    # arrivals of a time come at 2 t, what has left by then before the next arrivals at 2 t + 1
    arrive, leave = F.col("_us") * 2, (F.col("_us") + width_us) * 2 + 1
    # a value comes with its first row in a window's reach and goes with its last: rows in between,
    # which have the same value within the width on that side, change nothing
    come = go = F.lit(0)
    if distinct:
        near = Window.partitionBy(key, "_b", distinct).orderBy("_us")
        rows = rows.withColumn("_prev", F.lag("_us").over(near)).withColumn("_next", F.lead("_us").over(near))
        there = F.col(distinct).isNotNull()
        come = F.when(there & ~F.coalesce(F.col("_us") - F.col("_prev") <= width_us, F.lit(False)), 1).otherwise(0)
        go = F.when(there & ~F.coalesce(F.col("_next") - F.col("_us") <= width_us, F.lit(False)), -1).otherwise(0)
    steps = [F.struct(arrive.alias("at"), F.lit(1).alias("n"), come.alias("d"), F.lit(True).alias("real")),
             F.struct(leave.alias("at"), F.lit(-1).alias("n"), go.alias("d"), F.lit(False).alias("real"))]
    w = Window.partitionBy(key, "_b").orderBy("_s.at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    out = rows.withColumn("_s", F.explode(F.array(*steps)))
    out = out.withColumn("n_in_window", F.sum("_s.n").over(w))
    if distinct:
        out = out.withColumn("n_distinct", F.sum("_s.d").over(w).cast("int"))
    return out.filter(F.col("_s.real") & ~F.col("_ctx")).drop("_us", "_b", "_ctx", "_s", "_prev", "_next")


def velocity_burst(live: DataFrame, min_count: int = 5, width_s: int = 600) -> DataFrame:
    """Transactions that are at least the ``min_count``-th of their client
    within a trailing ``width_s`` window (R1)."""
    out = trailing_window(live.select("txn_id", "client_id", "initiated_at"), "client_id",
                          "initiated_at", width_s)
    return out.filter(F.col("n_in_window") >= min_count)


def card_testing(live: DataFrame, min_count: int = 10, width_s: int = 900,
                 low: float = 0.01, high: float = 1.99) -> DataFrame:
    """Tiny ONLINE amounts probing a card: >= ``min_count`` in ``width_s`` (R2)."""
    small = live.filter((F.col("channel") == "ONLINE") & F.col("amount").between(low, high))
    out = trailing_window(small.select("txn_id", "client_id", "amount", "initiated_at"), "client_id",
                          "initiated_at", width_s)
    return out.filter(F.col("n_in_window") >= min_count)


def high_value(live: DataFrame, min_amount: int = 3000) -> DataFrame:
    """Large international ONLINE/MOBILE transactions in a foreign currency."""
    return live.filter((F.col("amount") >= min_amount) & F.col("channel").isin(*ONLINE)
                       & (F.col("is_international") == 1) & (F.col("currency") != "USD")) \
               .select("txn_id", "client_id", "amount", "currency", "channel", "initiated_at")


def night_owl(live: DataFrame, min_count: int = 2) -> DataFrame:
    """Clients with >= ``min_count`` ONLINE/MOBILE transactions of 100-3,000
    between 01:00 and 04:59 in one night (R4)."""
    night = live.filter(F.hour("initiated_at").between(1, 4) & F.col("channel").isin(*ONLINE)
                        & F.col("amount").between(100, 3000))
    return (night.groupBy("client_id", F.col("initiated_at").cast("date").alias("night"))
                 .agg(F.count("*").alias("n_txns"), F.sum("amount").cast("decimal(38,2)").alias("total_amount"))
                 .filter(F.col("n_txns") >= min_count))


def international_spree(live: DataFrame, min_count: int = 3, min_currencies: int = 2,
                        width_s: int = 135 * 60) -> DataFrame:
    """>= ``min_count`` foreign-currency transactions in >= ``min_currencies``
    currencies within a trailing window (R5)."""
    foreign = live.filter(F.col("currency") != "USD").select("txn_id", "client_id", "currency", "initiated_at")
    out = trailing_window(foreign, "client_id", "initiated_at", width_s, distinct="currency")
    return (out.withColumnRenamed("n_distinct", "n_currencies")
               .filter((F.col("n_in_window") >= min_count) & (F.col("n_currencies") >= min_currencies)).drop("currency"))


def account_takeover(live: DataFrame, min_amount: int = 500) -> DataFrame:
    """First use of a device by a client who was already active, paying a
    foreign currency, ONLINE, >= ``min_amount`` (R6).

    First-seen times are two keyed aggregates (partial, map-side) joined
    back on their keys -- no per-client sort of all its rows."""
    base = live.select("txn_id", "client_id", "device_id", "amount", "currency", "channel",
                       "initiated_at")
    first_dev = base.groupBy("client_id", "device_id").agg(F.min("initiated_at").alias("device_first"))
    first_cli = first_dev.groupBy("client_id").agg(F.min("device_first").alias("client_first"))
    cand = base.filter((F.col("channel") == "ONLINE") & (F.col("currency") != "USD")
                       & (F.col("amount") >= min_amount) & F.col("device_id").isNotNull())
    return (cand.join(first_dev, ["client_id", "device_id"])
                .join(first_cli, "client_id")
                .filter((F.col("initiated_at") == F.col("device_first"))
                        & (F.col("initiated_at") > F.col("client_first")))
                .select("txn_id", "client_id", "device_id", "amount", "currency", "initiated_at"))


def rule_tags(flagged: DataFrame, include_night: bool = False) -> DataFrame:
    """All candidate alert rules of each flagged transaction, one row each."""
    pool = candidate_rules(F.abs(F.col("amount")), F.col("channel"), F.col("is_international"))
    if include_night:
        night = F.array(*[F.lit(r) for r in S.RULE_MAP["night"]])
        pool = F.array_sort(F.array_distinct(F.concat(pool, F.when(
            F.hour("initiated_at").between(1, 4), night).otherwise(F.array().cast("array<string>")))))
    return flagged.select("txn_id", F.explode(pool).alias("rule"))


def base_scores(flagged: DataFrame) -> DataFrame:
    """Base risk score of each flagged transaction."""
    return flagged.select("txn_id", F.abs("amount").alias("amount"),
                          alert_score(F.abs(F.col("amount")), F.lit(0)).alias("base_risk"))


def review_funnel(alerts: DataFrame) -> DataFrame:
    """Per rule: alerts, reviewed, confirmed, and their shares in basis points."""
    g = alerts.groupBy("rule_triggered").agg(
        F.count("*").alias("n_alerts"),
        F.count("reviewed_at").alias("n_reviewed"),
        F.sum(F.coalesce("is_confirmed", F.lit(0))).cast("bigint").alias("n_confirmed"))
    return g.select("rule_triggered", "n_alerts", "n_reviewed", "n_confirmed",
                    F.expr("n_reviewed * 10000 div n_alerts").alias("reviewed_bp"),
                    F.expr("n_confirmed * 10000 div nullif(n_reviewed, 0)").alias("confirmed_bp"))


def summary(txns: DataFrame, alerts: DataFrame) -> DataFrame:
    """One row: transactions, flagged, flagged share (bp), alerts, alerted
    transactions and alerts per alerted transaction x100 (A7)."""
    long = "bigint"
    t = txns.agg(F.count("*").alias("n_txns"),
                 F.sum(F.when(F.col("is_flagged") == 1, 1).otherwise(0)).cast(long).alias("n_flagged")) \
        .select("n_txns", "n_flagged", F.lit(None).cast(long).alias("n_alerts"),
                F.lit(None).cast(long).alias("n_alerted_txns"))
    a = alerts.agg(F.count("*").alias("n_alerts"), F.countDistinct("txn_id").alias("n_alerted_txns")) \
        .select(F.lit(None).cast(long).alias("n_txns"), F.lit(None).cast(long).alias("n_flagged"),
                "n_alerts", "n_alerted_txns")
    # two one-row aggregates folded into one row: a union and a global
    # aggregate, no join
    j = t.unionByName(a).agg(*[F.max(c).alias(c) for c in ("n_txns", "n_flagged", "n_alerts", "n_alerted_txns")])
    return j.select("n_txns", "n_flagged",
                    F.expr("n_flagged * 10000 div n_txns").alias("flagged_bp"),
                    "n_alerts", "n_alerted_txns",
                    F.expr("n_alerts * 100 div n_alerted_txns").alias("alerts_per_txn_x100"))
