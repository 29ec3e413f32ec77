"""Staging models: typed, cleaned, deduplicated views of the raw tables."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylake import schemas as S
from paylake.functions import clean_code, latest_per_key, pg_initcap


def _flag(c) -> F.Column:
    # CASE WHEN c = 1 THEN true ELSE false END: NULL falls to false
    return F.when(c == 1, True).otherwise(False)


def stg_transactions(raw: DataFrame) -> DataFrame:
    """Newest version of each transaction. NULL id/time rows are dropped
    *before* the dedup (F1), a NULL ``created_at`` wins (N1)."""
    cleaned = (raw
               .filter(F.col("txn_id").isNotNull() & F.col("initiated_at").isNotNull())
               .select(F.col("txn_id").alias("transaction_id"),
                       F.coalesce("client_id", F.lit(S.UNKNOWN_ID).cast("bigint")).alias("client_id"),
                       F.coalesce("merchant_id", F.lit(S.UNKNOWN_ID).cast("bigint")).alias("merchant_id"),
                       F.abs("amount").alias("amount"),
                       clean_code(F.col("currency"), S.DEFAULT_CURRENCY).alias("currency"),
                       F.col("initiated_at").alias("initiated_at_timestamp"),
                       F.col("created_at").alias("created_at_timestamp")))
    return latest_per_key(cleaned, ["transaction_id"],
                          [F.col("created_at_timestamp").desc_nulls_first()])


def stg_clean_transactions(stg: DataFrame) -> DataFrame:
    """Analysis-ready transactions. The staging layer already applied the
    defaults, ABS and UPPER (idempotent, D5), so this is a projection plus the
    not-null guard (F2)."""
    return (stg.filter(F.col("transaction_id").isNotNull()
                       & F.col("initiated_at_timestamp").isNotNull())
               .select("transaction_id", "client_id", "merchant_id", "amount", "currency",
                       "initiated_at_timestamp"))


def stg_clients(raw: DataFrame) -> DataFrame:
    """Newest row per client by ``registered_at`` (NULL first, N1)."""
    cleaned = raw.select(
        "client_id",
        F.trim("first_name").alias("first_name"),
        F.trim("last_name").alias("last_name"),
        F.coalesce(F.lower("email"), F.lit(S.MISSING_EMAIL_STAGING)).alias("email"),
        "country_id", "risk_score",
        _flag(F.col("is_active")).alias("is_active"),
        "registered_at")
    return latest_per_key(cleaned, ["client_id"], [F.col("registered_at").desc_nulls_first()])


def stg_countries(raw: DataFrame) -> DataFrame:
    """First name per country id, ascending with NULL last."""
    cleaned = raw.select(
        "country_id",
        pg_initcap(F.trim("name")).alias("country_name"),
        clean_code(F.col("currency"), "UNKNOWN").alias("local_currency"))
    return latest_per_key(cleaned, ["country_id"], [F.col("country_name").asc_nulls_last()])


def stg_transaction_statuses(raw: DataFrame) -> DataFrame:
    return raw.select("status_id", clean_code(F.col("label"), "UNKNOWN").alias("status_name"))


def stg_transaction_types(raw: DataFrame) -> DataFrame:
    return raw.select("type_id", clean_code(F.col("label"), "UNKNOWN").alias("type_name"),
                      _flag(F.col("is_debit")).alias("is_debit_type"))
