"""Mart models: dimensions with an unknown member, the fact, daily sales."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylake import schemas as S
from paylake.functions import (day_name_padded, month_name_padded, pg_initcap,
                               surrogate_key, unknown_member)


def dim_clients(stg_clients: DataFrame) -> DataFrame:
    risk = F.col("risk_score")
    cleaned = stg_clients.select(
        "client_id",
        # CONCAT skips NULLs in the warehouse; concat_ws does the same
        F.coalesce(F.nullif(F.trim(F.concat_ws(" ", "first_name", "last_name")), F.lit("")),
                   F.lit("Unknown Name")).alias("full_name"),
        F.coalesce("email", F.lit(S.MISSING_EMAIL_MART)).alias("email"),
        risk_category(risk).alias("risk_category"),
        "is_active", "registered_at")
    unknown = unknown_member(stg_clients.sparkSession, cleaned, {
        "client_id": S.UNKNOWN_ID, "full_name": "Unknown Client",
        "email": S.MISSING_EMAIL_MART, "risk_category": "Unrated", "is_active": False})
    return cleaned.unionByName(unknown)


def risk_category(risk) -> F.Column:
    """NULL -> Unrated, > 80 High, > 50 Medium, else Low."""
    return (F.when(risk.isNull(), "Unrated").when(risk > 80, "High Risk")
            .when(risk > 50, "Medium Risk").otherwise("Low Risk"))


def mcc_group(mcc) -> F.Column:
    out = F.when(mcc == S.MCC_GROUPS[0][0], S.MCC_GROUPS[0][1])
    for code, group in S.MCC_GROUPS[1:]:
        out = out.when(mcc == code, group)
    return out.otherwise("OTHER")


def dim_merchants(raw_merchants: DataFrame) -> DataFrame:
    """Read straight from the raw merchants with no dedup, and the onboarding
    time is ``created_at`` -- both as in the source model (D3)."""
    cleaned = raw_merchants.select(
        "merchant_id",
        F.coalesce(pg_initcap(F.col("trade_name")), F.lit("Unknown Merchant")).alias("merchant_name"),
        F.col("mcc").alias("merchant_category_code"),
        mcc_group(F.col("mcc")).alias("merchant_category_group"),
        F.col("created_at").alias("merchant_onboarded_at"))
    unknown = unknown_member(raw_merchants.sparkSession, cleaned, {
        "merchant_id": S.UNKNOWN_ID, "merchant_name": "Unknown Merchant",
        "merchant_category_group": "OTHER"})
    return cleaned.unionByName(unknown)


def region_of(country_name) -> F.Column:
    """Region by exact (case-sensitive) staging name; 'UAE' never matches
    the staged 'Uae' (D1, kept)."""
    return (F.when(country_name.isin(*S.MIDDLE_EAST), "Middle East")
            .when(country_name.isin(*S.AFRICA), "Africa")
            .when(country_name.isin(*S.EUROPE), "Europe").otherwise("Other"))


def dim_location(stg_countries: DataFrame) -> DataFrame:
    cleaned = stg_countries.select(
        "country_id",
        pg_initcap(F.col("country_name")).alias("country_name"),
        F.coalesce(F.upper("local_currency"), F.lit("N/A")).alias("local_currency"),
        region_of(F.col("country_name")).alias("region"))   # staging value (N10)
    keyed = cleaned.select(surrogate_key(F.col("country_id"), F.col("country_name")).alias("location_key"),
                           "country_id", "country_name", "local_currency", "region")
    unknown = unknown_member(stg_countries.sparkSession, keyed, {
        "location_key": "unknown", "country_id": S.UNKNOWN_ID, "country_name": "Unknown Country",
        "local_currency": "N/A", "region": "Unknown Region"})
    return keyed.unionByName(unknown)


def dim_date(dates: DataFrame | None = None, start: str = S.CALENDAR_START,
             end: str = S.CALENDAR_END) -> DataFrame:
    """Calendar from ``start`` to ``end`` inclusive, widened to cover every
    ``date_key`` of ``dates`` when given (the fixed span is D13's default).

    The bounds come from one global min/max aggregate over a single column
    (partial per task, one row shuffled); the days are exploded from that
    one row, so the calendar never re-runs the fact's dedup."""
    if dates is not None:
        bounds = dates.agg(F.least(F.lit(start).cast("date"), F.min("date_key")).alias("lo"),
                          F.greatest(F.lit(end).cast("date"), F.max("date_key")).alias("hi"))
        bounds = bounds.select(F.coalesce("lo", F.lit(start).cast("date")).alias("lo"),
                               F.coalesce("hi", F.lit(end).cast("date")).alias("hi"))
        days = bounds.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("d"))
    else:
        from pyspark.sql import SparkSession
        spark = SparkSession.getActiveSession()
        days = spark.range(1).select(F.explode(F.sequence(
            F.lit(start).cast("date"), F.lit(end).cast("date"), F.expr("INTERVAL 1 DAY"))).alias("d"))
    d = F.col("d")
    iso_dow = F.weekday(d) + 1
    return days.select(
        d.alias("date_key"),
        F.year(d).alias("year"), F.month(d).alias("month"), F.dayofmonth(d).alias("day"),
        month_name_padded(d).alias("month_name"),
        day_name_padded(d).alias("day_name"),
        F.when(iso_dow.isin(5, 6), "Weekend").otherwise("Weekday").alias("day_type"),
        F.concat(F.lit("Q"), F.quarter(d).cast("string")).alias("quarter"))


def fact_transactions(stg_clean: DataFrame) -> DataFrame:
    """One row per clean transaction with its date key. Null keys were
    already mapped to -1 in staging (D5), so they meet the unknown member."""
    return stg_clean.select("transaction_id", "client_id", "merchant_id", "amount", "currency",
                            "initiated_at_timestamp",
                            F.col("initiated_at_timestamp").cast("date").alias("date_key"))


def fct_daily_merchant_sales(fact: DataFrame) -> DataFrame:
    """Count, sum and rounded mean per (day, merchant, currency).

    A hash aggregate with a partial (map-side) step: each task reduces its
    rows to one per group before the exchange, so a merchant holding a third
    of all rows costs one row per task, not a third of the data in one task.
    The mean is the decimal average rounded half-up to cents (N7)."""
    return (fact.groupBy(F.col("date_key").alias("transaction_date"), "merchant_id", "currency")
                .agg(F.count("transaction_id").alias("total_transaction_count"),
                     F.sum("amount").cast("decimal(38,2)").alias("daily_total_amount"),
                     F.round(F.avg("amount"), 2).cast("decimal(18,2)").alias("avg_transaction_value")))
