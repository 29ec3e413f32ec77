"""Project the driver's tables into the raw payment-gateway schemas.

The driver ships TPC-H-style tables, not payment tables. This module maps
them, row for row, onto the operational schemas (transactions, clients,
merchants, ...). Dirt the cleaning models must handle -- NULL keys, blank and
lower-case codes, negative amounts, duplicate versions of a row -- is injected
by key arithmetic, never by random numbers, so every engine sees the same rows.

Every mapping is a per-row projection (plus a bounded ``explode`` for
versioned rows); nothing here shuffles except the lineitem-orders join, which
is a key-on-key equi-join, always a sort-merge join.
"""
from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylake import schemas as S

EPOCH_DAY = "1995-01-01"   # first day of the driver's order dates
FOLD_DAYS = 730            # fold driver dates into the model calendar


def _arr(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def fold_date(c: Column) -> Column:
    """Map a driver date onto the 2025-2026 model calendar."""
    return F.date_add(F.lit(S.CALENDAR_START).cast("date"),
                      F.datediff(c.cast("date"), F.lit(EPOCH_DAY).cast("date")) % FOLD_DAYS)


def at_seconds(day: Column, secs: Column) -> Column:
    return F.timestamp_add("SECOND", secs, day.cast("timestamp_ntz"))


def _status(bucket: Column) -> Column:
    # shares per thousand: approved 730, declined 140, settled 80,
    # pending 30, failed 15, reversed 3, chargeback 2
    return (F.when(bucket < 730, 1).when(bucket < 870, 2).when(bucket < 950, 6)
            .when(bucket < 980, 3).when(bucket < 995, 5).when(bucket < 998, 4)
            .otherwise(7)).cast("int")


def _channel(bucket: Column) -> Column:
    # shares per hundred: POS 55, ONLINE 25, ATM 8, MOBILE 10, IVR 2
    return (F.when(bucket < 55, "POS").when(bucket < 80, "ONLINE")
            .when(bucket < 88, "ATM").when(bucket < 98, "MOBILE").otherwise("IVR"))


def _live_currency(bucket: Column) -> Column:
    return (F.when(bucket < 10, "USD").when(bucket < 13, "EUR").when(bucket < 15, "GBP")
            .when(bucket < 17, "EGP").when(bucket == 17, "SAR").when(bucket == 18, "AED")
            .otherwise("CAD"))


class RawTables:
    """Raw operational tables derived from the driver tables."""

    def __init__(self, tables):
        self.t = tables
        self.spark = tables.spark

    # -- transactions ------------------------------------------------------
    @cached_property
    def transactions(self) -> DataFrame:
        return self.transactions_among()

    def transactions_among(self, only: Callable[..., DataFrame] | None = None) -> DataFrame:
        """The transactions; with ``only(rows, txn_id)`` those of the items that it keeps, before any join."""
        l = self.t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                                   "l_extendedprice", "l_returnflag", "l_shipdate")
        ok, pk, ln = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_linenumber")
        txn_id = lambda k: F.when((pk % 97 == 0) & (ln == 1), F.lit(None)).otherwise(k)
        if only is not None:
            l = only(l, txn_id(ok * 10 + ln))
        o = self.t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey",
                                 "o_orderdate")
        # sort-merge whatever the planner guesses: one narrow key column of the orders looks small
        # enough to broadcast when it is not, and would be built whole in the driver
        j = l.join(o.hint("merge"), "l_orderkey")
        k = ok * 10 + ln
        has_pos = (ok % 10) < 7
        merchant = F.col("l_suppkey")
        amount0 = (F.col("l_extendedprice").cast("decimal(14,2)")
                   * F.lit(0.04).cast("decimal(3,2)")).cast("decimal(14,2)")
        cur0 = (F.when(F.col("l_returnflag") == "A", "USD")
                .when(F.col("l_returnflag") == "N", "EUR").otherwise("GBP"))
        init_day = fold_date(F.col("o_orderdate"))
        init_secs = (ok * 37 + ln * 600) % 86400
        j = j.select(
            "*",
            k.alias("_k"),
            amount0.alias("_amount0"),
            cur0.alias("_cur0"),
            _status((ok * 7 + ln * 13) % 1000).alias("status_id"),
            _channel((ok * 3 + ln) % 100).alias("channel"),
            F.when((ok % 53 == 0) & (ln == 2), F.lit(None))
             .otherwise(at_seconds(init_day, init_secs)).alias("initiated_at"),
        )
        k, amount0, cur0 = F.col("_k"), F.col("_amount0"), F.col("_cur0")
        status, channel = F.col("status_id"), F.col("channel")
        online = channel.isin("ONLINE", "MOBILE")
        amount = F.when(pk % 29 == 0, -amount0).otherwise(amount0)
        fee = (amount0 * F.lit(0.02).cast("decimal(3,2)")
               + F.lit(0.10).cast("decimal(3,2)")).cast("decimal(10,2)")
        initiated = F.col("initiated_at")
        return j.select(
            txn_id(k).alias("txn_id"),
            F.concat(F.lit("TXN-"), ok.cast("string"), F.lit("-"), ln.cast("string")).alias("reference"),
            F.when(ok % 31 == 0, F.lit(None)).otherwise(F.col("o_custkey")).alias("client_id"),
            (F.col("o_custkey") * 3 + ln % (F.col("o_custkey") % 3 + 1)).alias("card_id"),
            # a few terminals are unknown to the terminal table (orphans)
            F.when(has_pos & (pk % 53 == 0), merchant * 3 + ln % 3 + 900_000_000)
             .when(has_pos, merchant * 3 + ln % 3).alias("pos_id"),
            F.when(~has_pos & (pk % 17 == 0), F.lit(None)).otherwise(merchant).alias("merchant_id"),
            (pk % 7 + 1).cast("int").alias("type_id"),
            status,
            amount.cast("decimal(14,2)").alias("amount"),
            F.when(pk % 41 == 0, F.lit(None))
             .when(pk % 23 == 0, F.concat(F.lit(" "), F.lower(cur0), F.lit(" ")))
             .otherwise(cur0).alias("currency"),
            fee.alias("fee"),
            (amount - fee).cast("decimal(14,2)").alias("net_amount"),
            F.when(status == 1, F.concat(F.lit("AUTH"), F.lpad((k % 1000000).cast("string"), 6, "0")))
             .alias("auth_code"),
            channel,
            F.when(online, F.concat_ws(".", F.lit("10"), (F.col("o_custkey") % 256).cast("string"),
                                       ln.cast("string"), (ok % 256).cast("string")))
             .alias("ip_address"),
            F.when(online, F.concat(F.lit("dev-"), F.col("o_custkey").cast("string"), F.lit("-"),
                                    (ok % 4).cast("string"))).alias("device_id"),
            F.when(ok % 12 == 0, 1).otherwise(0).alias("is_recurring"),
            F.when((cur0 != "USD") & (pk % 3 == 0), 1).otherwise(0).alias("is_international"),
            F.when((amount0 > 2500) & (pk % 5 == 0), 1)
             .when((channel == "ONLINE") & (pk % 11 == 0), 1).otherwise(0).alias("is_flagged"),
            F.when(status == 2, F.element_at(_arr(S.DECLINE_REASONS), (k % 6 + 1).cast("int")))
             .when(status == 5, F.element_at(_arr(S.FAIL_REASONS), (k % 3 + 1).cast("int")))
             .alias("failure_reason"),
            initiated,
            F.timestamp_add("SECOND", k % 8 + 1, initiated).alias("processed_at"),
            F.when(status == 6, F.date_add(initiated.cast("date"), (k % 3 + 1).cast("int")))
             .alias("settled_at"),
            F.when(pk % 43 == 0, F.lit(None))
             .otherwise(at_seconds(fold_date(F.col("l_shipdate")), ln * 60)).alias("created_at"),
        )

    # -- clients (customer), with later and null-dated versions -----------
    @cached_property
    def clients(self) -> DataFrame:
        c = self.t.customer.select("c_custkey", "c_name", "c_nationkey", "c_acctbal",
                                   "c_mktsegment")
        ck = F.col("c_custkey")
        nver = F.when(ck % 20 == 5, 2).when(ck % 10 == 0, 1).otherwise(0)
        c = c.withColumn("v", F.explode(F.sequence(F.lit(0), nver)))
        v = F.col("v")
        first = F.split_part(F.col("c_name"), F.lit("#"), F.lit(1))
        base_risk = (F.floor(F.col("c_acctbal")).cast("bigint") % 101)
        reg0 = F.timestamp_add("DAY", ck % 365, F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
        registered = (F.when(v == 2, F.lit(None))
                      .when(v == 1, F.timestamp_add("DAY", F.lit(30), reg0)).otherwise(reg0))
        email = F.concat(F.lit("Client."), ck.cast("string"), F.lit("@Mail.Example"))
        return c.select(
            ck.alias("client_id"),
            F.when(ck % 19 == 0, F.lit(None))
             .when(ck % 19 == 1, F.concat(F.lit("  "), first, F.lit(" "))).otherwise(first)
             .alias("first_name"),
            F.when(ck % 13 == 0, F.lit(None))
             .otherwise(F.split_part(F.col("c_name"), F.lit("#"), F.lit(2))).alias("last_name"),
            F.when(ck % 11 == 0, F.lit(None)).when(v == 1, F.upper(email)).otherwise(email)
             .alias("email"),
            F.concat(F.lit("+1-"), F.lpad(ck.cast("string"), 7, "0")).alias("phone"),
            F.concat(F.lit("NID"), ck.cast("string")).alias("national_id"),
            F.col("c_nationkey").cast("int").alias("country_id"),
            F.col("c_mktsegment").alias("city"),
            F.when(F.col("c_acctbal") < 0, F.lit(None))
             .when(v == 1, (base_risk + 50) % 101).otherwise(base_risk).cast("int")
             .alias("risk_score"),
            F.when(ck % 9 == 0, 0).when(ck % 9 == 1, F.lit(None)).otherwise(1).cast("int")
             .alias("is_active"),
            registered.alias("registered_at"),
            F.coalesce(registered, reg0).alias("created_at"),
        )

    # -- merchants (supplier); a few appear twice (D3) ---------------------
    @cached_property
    def merchants(self) -> DataFrame:
        s = self.t.supplier.select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
        sk = F.col("s_suppkey")
        s = s.withColumn("v", F.explode(F.sequence(F.lit(0), F.when(sk % 25 == 3, 1).otherwise(0))))
        created0 = F.timestamp_add("DAY", sk % 365, F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
        return s.select(
            sk.alias("merchant_id"),
            F.col("s_name").alias("legal_name"),
            F.when(sk % 17 == 0, F.lit(None))
             .when(sk % 2 == 0, F.concat(F.lower(F.regexp_replace("s_name", "#", "-")), F.lit(" o'shop")))
             .otherwise(F.concat(F.regexp_replace("s_name", "#", " "), F.lit(" LLC")))
             .alias("trade_name"),
            F.when(sk % 16 == 15, F.lit(None))
             .otherwise(F.element_at(_arr([m for m, _ in S.MERCHANT_CATEGORIES]), (sk % 15 + 1).cast("int")))
             .cast("int").alias("mcc"),
            F.concat(F.lit("TAX"), sk.cast("string")).alias("tax_id"),
            # a few merchants name a country that does not exist (orphans)
            F.when(sk % 31 == 30, 99).otherwise(F.col("s_nationkey")).cast("int").alias("country_id"),
            F.when(F.col("s_acctbal") < 0, 0).otherwise(1).cast("int").alias("is_active"),
            F.timestamp_add("DAY", sk % 365, F.lit("2023-01-01 00:00:00").cast("timestamp_ntz"))
             .alias("onboarded_at"),
            F.when(sk % 19 == 7, F.lit(None))
             .otherwise(F.timestamp_add("DAY", F.col("v"), created0)).alias("created_at"),
        )

    # -- countries (nation x region); some ids carry a second, worse row ---
    @cached_property
    def countries(self) -> DataFrame:
        n = self.t.nation.join(
            self.t.region.withColumnRenamed("r_regionkey", "n_regionkey"), "n_regionkey", "left")
        nk = F.col("n_nationkey")
        n = n.withColumn("v", F.explode(F.sequence(F.lit(0), F.when(
            F.col("n_regionkey").isin(2, 3), 1).otherwise(0))))
        v = F.col("v")
        names = _arr([name for _, name, _ in S.COUNTRIES])
        curs = _arr([cur for _, _, cur in S.COUNTRIES])
        codes = _arr([code for code, _, _ in S.COUNTRIES])
        known = nk < 10
        name0 = F.when(known, F.element_at(names, (nk + 1).cast("int"))).otherwise(F.col("n_name"))
        name1 = (F.when(nk % 12 == 11, F.lit(None))
                 .when(nk % 6 == 4, F.concat(F.lit("  "), F.lower(name0), F.lit(" ")))
                 .otherwise(name0))
        name = (F.when(v == 0, name1)
                .when(F.col("n_regionkey") == 2, F.concat(F.lit("zz "), name0))
                .otherwise(F.lit(None)))
        cur = (F.when(nk % 8 == 7, F.lit(None))
               .when(known, F.element_at(curs, (nk + 1).cast("int")))
               .otherwise(F.lower(F.substring("r_name", 1, 3))))
        return n.select(
            nk.cast("int").alias("country_id"),
            F.when(known, F.element_at(codes, (nk + 1).cast("int")))
             .otherwise(F.concat(F.lit("C"), F.lpad(nk.cast("string"), 2, "0"))).alias("code"),
            name.alias("name"),
            cur.alias("currency"),
            F.timestamp_add("DAY", nk + v, F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
             .alias("created_at"),
        )

    # -- lookups: the fixed reference rows actually used by the data -------
    def _lookup(self, rows, schema) -> DataFrame:
        return self.spark.createDataFrame(rows, schema)

    @cached_property
    def status_lookup(self) -> DataFrame:
        """All fixed status rows, for joins; ``transaction_statuses`` lists those in use."""
        return self._lookup(S.TRANSACTION_STATUSES, "status_id int, code string, label string")

    @cached_property
    def transaction_statuses(self) -> DataFrame:
        lk = self._lookup(S.TRANSACTION_STATUSES, "status_id int, code string, label string")
        used = self.transactions.select("status_id").distinct()
        # the fixed lookup (seven rows) is the broadcast side
        return used.join(F.broadcast(lk), "status_id").select(*lk.columns)

    @cached_property
    def transaction_types(self) -> DataFrame:
        lk = self._lookup(S.TRANSACTION_TYPES, "type_id int, code string, label string, is_debit int")
        used = self.transactions.select("type_id").distinct()
        return used.join(F.broadcast(lk), "type_id").select(*lk.columns)

    @cached_property
    def card_networks(self) -> DataFrame:
        return self._lookup(S.CARD_NETWORKS, "network_id int, name string, prefix_regex string")

    @cached_property
    def merchant_categories(self) -> DataFrame:
        return self._lookup(S.MERCHANT_CATEGORIES, "mcc int, description string")

    # -- terminals and cards ------------------------------------------------
    @cached_property
    def pos_terminals(self) -> DataFrame:
        s = self.t.supplier.select("s_suppkey")
        s = s.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(2))))
        pos = F.col("s_suppkey") * 3 + F.col("k")
        return s.select(
            pos.alias("pos_id"),
            F.concat(F.lit("SN"), F.lpad(pos.cast("string"), 8, "0")).alias("serial_number"),
            F.col("s_suppkey").alias("merchant_id"),
            F.when(F.col("k") == 0, "A920").when(F.col("k") == 1, "Move5000").otherwise("V240m")
             .alias("model"),
            F.lit(1).alias("is_active"),
            F.timestamp_add("DAY", F.col("s_suppkey") % 365,
                            F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")).alias("created_at"),
        )

    @cached_property
    def payment_cards(self) -> DataFrame:
        c = self.t.customer.select("c_custkey", "c_name")
        ck = F.col("c_custkey")
        c = c.withColumn("k", F.explode(F.sequence(F.lit(0), ck % 3)))
        k = F.col("k")
        card = ck * 3 + k
        return c.select(
            card.alias("card_id"),
            ck.alias("client_id"),
            (card % 4 + 1).cast("int").alias("network_id"),
            F.concat(F.lit("************"), F.lpad((card % 10000).cast("string"), 4, "0")).alias("masked_pan"),
            F.concat(F.lit("tok_"), card.cast("string")).alias("card_token"),
            F.col("c_name").alias("holder_name"),
            (card % 12 + 1).cast("int").alias("expiry_month"),
            (card % 4 + 2026).cast("int").alias("expiry_year"),
            F.when((k == 0) | ((ck % 37 == 0) & (k == 1)), 1).otherwise(0).alias("is_default"),
            F.lit(1).alias("is_active"),
            F.timestamp_add("DAY", ck % 365, F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
             .alias("created_at"),
        )

    # -- refunds and alerts, derived from the raw transactions -------------
    @cached_property
    def refunds(self) -> DataFrame:
        t = self.transactions.filter((F.col("status_id") == 1) & F.col("txn_id").isNotNull()
                                     & (F.col("txn_id") % 19 == 0))
        k = F.col("txn_id")
        full = F.abs(F.col("amount"))
        init = F.timestamp_add("DAY", k % 30, F.col("initiated_at"))
        return t.select(
            k.alias("refund_id"),
            k.alias("original_txn_id"),
            F.concat(F.lit("RFD-"), k.cast("string")).alias("reference"),
            F.when(k % 10 < 3, (full * F.lit(0.5).cast("decimal(2,1)")).cast("decimal(14,2)"))
             .otherwise(full).cast("decimal(14,2)").alias("amount"),
            F.element_at(_arr(S.REFUND_REASONS), (k % 6 + 1).cast("int")).alias("reason"),
            # refunds are approved, a few later reversed
            F.when(k % 23 == 0, 4).otherwise(1).cast("int").alias("status_id"),
            init.alias("initiated_at"),
            F.timestamp_add("HOUR", k % 72 + 1, init).alias("resolved_at"),
            F.col("created_at"),
        )

    @cached_property
    def fraud_alerts(self) -> DataFrame:
        t = self.transactions.filter((F.col("is_flagged") == 1) & F.col("txn_id").isNotNull())
        t = t.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("txn_id") % 3)))
        k, i = F.col("txn_id"), F.col("i")
        pool = candidate_rules(F.abs(F.col("amount")), F.col("channel"), F.col("is_international"))
        reviewed = (k + i) % 10 < 7
        return t.select(
            (k * 10 + i).alias("alert_id"),
            k.alias("txn_id"),
            F.element_at(pool, ((k + i) % F.size(pool) + 1).cast("int")).alias("rule_triggered"),
            alert_score(F.abs(F.col("amount")), (k % 16) - 5).alias("risk_score"),
            F.when(reviewed, F.when((k + i) % 5 < 2, 1).otherwise(0)).alias("is_confirmed"),
            F.when(reviewed, F.concat(F.lit("analyst_"), ((k + i) % 9).cast("string"))).alias("reviewed_by"),
            F.when(reviewed, F.timestamp_add("DAY", k % 7 + 1, F.col("initiated_at"))).alias("reviewed_at"),
            F.col("processed_at").alias("created_at"),
        )

    # -- live transactions (events) with injected fraud campaigns ----------
    @cached_property
    def live_transactions(self) -> DataFrame:
        e = self.t.events.select("event_id", "ts", "user_id", "event_type", "value", "props")
        eid = F.col("event_id")
        amount = (F.col("value").cast("decimal(12,2)") * 20).cast("decimal(14,2)")
        channel = (F.when(F.col("event_type").isin("click", "signup"), "ONLINE")
                   .when(F.col("event_type") == "view", "MOBILE")
                   .when(F.col("event_type") == "purchase", "POS").otherwise("ATM"))
        currency = _live_currency(eid % 20)
        device = F.concat(F.lit("d"), F.get_json_object("props", "$.k"))
        base = e.select(
            (eid * 100).alias("txn_id"),
            F.col("user_id").alias("client_id"),
            amount.alias("amount"),
            currency.alias("currency"),
            channel.alias("channel"),
            F.when((currency != "USD") & (eid % 3 == 0), 1).otherwise(0).alias("is_international"),
            device.alias("device_id"),
            F.col("ts").alias("initiated_at"),
        )
        # campaigns: 0 card testing / velocity burst, 1 international spree,
        # 2 account takeover, 3 night owl, 4 high value
        kind = eid % 200
        camp = e.filter(kind < 5).withColumn("kind", kind)
        n = (F.when(F.col("kind") == 0, 12).when(F.col("kind") == 1, 6)
             .when(F.col("kind") == 3, 2).otherwise(1))
        camp = camp.withColumn("i", F.explode(F.sequence(F.lit(0), n - 1)))
        kd, i = F.col("kind"), F.col("i")
        night_start = at_seconds(F.col("ts").cast("date"), F.lit(7200) + i * 900)
        spree_cur = F.element_at(F.array(F.lit("EUR"), F.lit("GBP"), F.lit("AED")), (i % 3 + 1).cast("int"))
        c_amount = (F.when(kd == 0, F.lit(0.5).cast("decimal(14,2)") + i.cast("decimal(14,2)") * F.lit(0.1).cast("decimal(3,2)"))
                    .when(kd == 1, amount + 200)
                    .when(kd == 2, (F.col("value").cast("decimal(12,2)") * 10 + 500))
                    .when(kd == 3, F.col("value").cast("decimal(12,2)") + 100)
                    .otherwise(F.col("value").cast("decimal(12,2)") * 10 + 3000)).cast("decimal(14,2)")
        c_cur = (F.when(kd == 0, "USD").when(kd == 1, spree_cur).when(kd == 2, "EUR")
                 .when(kd == 3, "USD").otherwise("GBP"))
        c_ts = (F.when(kd == 0, F.timestamp_add("SECOND", i * 20, F.col("ts")))
                .when(kd == 1, F.timestamp_add("MINUTE", i * 10, F.col("ts")))
                .when(kd == 2, F.timestamp_add("MINUTE", F.lit(1), F.col("ts")))
                .when(kd == 3, night_start)
                .otherwise(F.timestamp_add("MINUTE", F.lit(2), F.col("ts"))))
        campaigns = camp.select(
            (eid * 100 + 1 + i).alias("txn_id"),
            F.col("user_id").alias("client_id"),
            c_amount.alias("amount"),
            c_cur.alias("currency"),
            F.when((kd == 3) & (i == 1), "MOBILE").otherwise("ONLINE").alias("channel"),
            F.when(kd.isin(1, 2, 4), 1).otherwise(0).alias("is_international"),
            F.when(kd == 2, F.concat(F.lit("new-"), eid.cast("string"))).otherwise(device).alias("device_id"),
            c_ts.alias("initiated_at"),
        )
        return base.unionByName(campaigns)


def candidate_rules(amount: Column, channel: Column, is_international: Column) -> Column:
    """Distinct candidate alert rules for a transaction, sorted by name."""
    pool = F.concat(
        _arr(S.RULE_MAP["generic"]),
        F.when(amount > 3000, _arr(S.RULE_MAP["high_amount"])).otherwise(F.array().cast("array<string>")),
        F.when(channel.isin("ONLINE", "MOBILE"), _arr(S.RULE_MAP["online"]))
         .otherwise(F.array().cast("array<string>")),
        F.when(is_international == 1, _arr(S.RULE_MAP["international"]))
         .otherwise(F.array().cast("array<string>")),
    )
    return F.array_sort(F.array_distinct(pool))


def alert_score(amount: Column, jitter: Column) -> Column:
    """Base risk 60 / 75 / 90 below 1,000 / below 3,000 / above, capped at 100."""
    base = F.when(amount < 1000, 60).when(amount < 3000, 75).otherwise(90)
    return F.least(F.lit(100), base + jitter).cast("int")
