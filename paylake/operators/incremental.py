"""Tables kept up to date by the days that changed: settlements, and facts whose dimension
rows came late. Both are partitioned by day, and a run rewrites the partitions it names."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paylake import schemas as S
from paylake.functions import clean_code
from paylake.operators.recon import APPROVED_CODES, current_transactions, with_status
from paylake.sources import commits
from paylake.sources.commits import read_or_empty

SETTLEMENT = ("merchant_id bigint, currency string, txn_count bigint, gross_amount decimal(16,2), total_fees decimal(14,2), "
              "net_payout decimal(16,2), batch_date date")


def settlement_by_currency(current: DataFrame, statuses: DataFrame) -> DataFrame:
    """Approved and settled transactions per merchant, day and currency: count, gross, fees and
    net. Amounts of different currencies are never added."""
    ok = with_status(current, statuses).filter(
        F.col("status_code").isin(*APPROVED_CODES) & F.col("merchant_id").isNotNull() & F.col("initiated_at").isNotNull())
    g = (ok.groupBy("merchant_id", F.col("initiated_at").cast("date").alias("batch_date"),
                    clean_code(F.col("currency"), "USD").alias("currency"))
           .agg(F.count("*").alias("txn_count"), F.sum(F.abs("amount")).cast("decimal(16,2)").alias("gross_amount"),
                F.sum("fee").cast("decimal(14,2)").alias("total_fees")))
    return g.select("merchant_id", "currency", "txn_count", "gross_amount", "total_fees",
                    (F.col("gross_amount") - F.col("total_fees")).cast("decimal(16,2)").alias("net_payout"), "batch_date")


def _days(spark: SparkSession, days: DataFrame) -> list:
    """Distinct days as values for partition pruning: as many as the calendar has at most."""
    return sorted(r[0] for r in days.distinct().collect() if r[0] is not None)


def _rewrite(df: DataFrame, out: str, column: str, days: list) -> None:
    """Replace the partitions of ``days`` by the rows of ``df``; a day without rows goes. ``df`` may
    come from the table itself: it is written beside it first."""
    spark = df.sparkSession
    beside = f"{out.rstrip('/')}_next"
    df.hint("rebalance", column).write.mode("overwrite").partitionBy(column).parquet(beside)
    fresh = read_or_empty(spark, beside, df.schema)
    kept = set(_days(spark, fresh.select(column)))
    fresh.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(out)
    for day in days:
        if day not in kept:
            commits.remove(spark, f"{out}/{column}={day}")
    commits.remove(spark, beside)


def settle(raw_txn: DataFrame, new: DataFrame, statuses: DataFrame, out: str) -> list:
    """Bring the settlement table at ``out`` up to date with ``new``, transaction versions that have
    arrived in ``raw_txn`` since the last run (R9). The days touched are those of all versions
    of the new transactions, so one that moved leaves its old day too; they are computed again
    from ``raw_txn``, other days are neither read nor written. Returns the days."""
    ids = new.select("txn_id").filter(F.col("txn_id").isNotNull()).distinct()
    day = F.col("initiated_at").cast("date")
    days = _days(raw_txn.sparkSession, raw_txn.join(ids, "txn_id", "left_semi").select(day.alias("d")))
    if not days:
        return []
    # all versions of the transactions that have a version on these days, then the current ones
    near = raw_txn.filter(day.isin(days)).select("txn_id").distinct()
    current = current_transactions(raw_txn.join(near, "txn_id", "left_semi")).filter(day.isin(days))
    _rewrite(settlement_by_currency(current, statuses), out, "batch_date", days)
    return days


def read_settlements(spark: SparkSession, out: str) -> DataFrame:
    return read_or_empty(spark, out, SETTLEMENT)


# -- facts with all their dimensions ---------------------------------------

def _known(keys: DataFrame, key: str, name: str) -> DataFrame:
    return keys.select(F.col(key).alias(f"_{name}")).filter(F.col(f"_{name}").isNotNull()).distinct()


def star_keys(fact: DataFrame, dims: dict[str, DataFrame], clients: DataFrame, countries: DataFrame, dates: DataFrame) -> DataFrame:
    """Each fact row with the keys of its four dimensions (J7): ``client_key``, ``merchant_key``,
    ``location_key`` (the client's country) and ``date_key``. A key that a dimension does not
    have yet is that of the unknown member, beside the row's own id, by which it can be found
    again. Dimensions are joined by key, one row each; AQE chooses the strategy by size.

    ``dims`` has ``dim_clients`` and ``dim_merchants``, ``clients`` the clients' countries and
    ``countries`` is ``dim_location``."""
    c, m = _known(dims["dim_clients"], "client_id", "c"), _known(dims["dim_merchants"], "merchant_id", "m")
    home = clients.select(F.col("client_id").alias("_h"), "country_id")
    place = countries.select(F.col("country_id").alias("_p"), F.col("location_key").alias("_location"))
    day = dates.select(F.col("date_key").alias("_d"))
    j = (fact.join(c, F.col("client_id") == F.col("_c"), "left").join(m, F.col("merchant_id") == F.col("_m"), "left")
             .join(home, F.col("client_id") == F.col("_h"), "left").join(place, F.col("country_id") == F.col("_p"), "left")
             .join(day, F.col("date_key") == F.col("_d"), "left"))
    unknown = F.lit(S.UNKNOWN_ID).cast("bigint")
    return j.select("transaction_id", "client_id", "merchant_id", F.coalesce("_c", unknown).alias("client_key"),
                    F.coalesce("_m", unknown).alias("merchant_key"), F.coalesce("_location", F.lit("unknown")).alias("location_key"),
                    "amount", "currency", F.col("_d").alias("calendar_day"), "date_key")


def waiting(star: DataFrame) -> Column:
    """Rows that met an unknown member although they name a client or merchant of their own."""
    return (((F.col("merchant_key") == S.UNKNOWN_ID) & (F.col("merchant_id") != S.UNKNOWN_ID))
            | ((F.col("client_key") == S.UNKNOWN_ID) & (F.col("client_id") != S.UNKNOWN_ID)))


def write_star(star: DataFrame, out: str) -> None:
    star.hint("rebalance", "date_key").write.mode("overwrite").partitionBy("date_key").parquet(out)


def rekey(spark: SparkSession, out: str, dims: dict[str, DataFrame], clients: DataFrame, countries: DataFrame, dates: DataFrame) -> list:
    """Move facts from the unknown member to dimension rows that came late (T5): the days with a
    waiting row whose client or merchant is there now are joined again and rewritten,
    other days stay untouched. Returns those days."""
    star = spark.read.parquet(out)
    late = star.filter(waiting(star)).select("client_id", "merchant_id", "client_key", "merchant_key", "date_key")
    c, m = _known(dims["dim_clients"], "client_id", "c"), _known(dims["dim_merchants"], "merchant_id", "m")
    found = (late.join(c, F.col("client_id") == F.col("_c"), "left").join(m, F.col("merchant_id") == F.col("_m"), "left")
             .filter((F.col("_c").isNotNull() & (F.col("client_key") != F.col("_c")))
                     | (F.col("_m").isNotNull() & (F.col("merchant_key") != F.col("_m")))))
    days = _days(spark, found.select("date_key"))
    if days:
        fact = star.filter(F.col("date_key").isin(days)).select("transaction_id", "client_id", "merchant_id", "amount", "currency", "date_key")
        _rewrite(star_keys(fact, dims, clients, countries, dates), out, "date_key", days)
    return days
