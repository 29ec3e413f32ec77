"""The model graph: each model is a function of the models it references.

``Warehouse(tables).fct_daily_merchant_sales`` builds one lazy plan from raw
scan to aggregate; Catalyst collapses the view-on-view chain into a single
optimised plan (scan -> filter -> exchange(id) -> window -> partial agg ->
exchange(group) -> final agg).
"""
from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import DataFrame

from paylake.operators import marts, staging


class Warehouse:
    def __init__(self, tables):
        self.t = tables
        self.raw = tables.raw

    @cached_property
    def stg_transactions(self) -> DataFrame:
        return staging.stg_transactions(self.raw.transactions)

    @cached_property
    def stg_clean_transactions(self) -> DataFrame:
        return staging.stg_clean_transactions(self.stg_transactions)

    @cached_property
    def stg_clients(self) -> DataFrame:
        return staging.stg_clients(self.raw.clients)

    @cached_property
    def stg_countries(self) -> DataFrame:
        return staging.stg_countries(self.raw.countries)

    @cached_property
    def stg_transaction_statuses(self) -> DataFrame:
        return staging.stg_transaction_statuses(self.raw.transaction_statuses)

    @cached_property
    def stg_transaction_types(self) -> DataFrame:
        return staging.stg_transaction_types(self.raw.transaction_types)

    @cached_property
    def dim_clients(self) -> DataFrame:
        return marts.dim_clients(self.stg_clients)

    @cached_property
    def dim_merchants(self) -> DataFrame:
        return marts.dim_merchants(self.raw.merchants)

    @cached_property
    def dim_location(self) -> DataFrame:
        return marts.dim_location(self.stg_countries)

    @cached_property
    def dim_date(self) -> DataFrame:
        # every date a transaction can carry: the raw initiation dates
        from pyspark.sql import functions as F
        return marts.dim_date(self.raw.transactions.select(
            F.col("initiated_at").cast("date").alias("date_key")))

    @cached_property
    def fact_transactions(self) -> DataFrame:
        return marts.fact_transactions(self.stg_clean_transactions)

    @cached_property
    def fct_daily_merchant_sales(self) -> DataFrame:
        return marts.fct_daily_merchant_sales(self.fact_transactions)

    def register_views(self, prefix: str = "") -> list[str]:
        """Expose every model as a temp view (the warehouse source/ref
        catalogue, S12/S13); SQL over the views is planned by Catalyst like
        the DataFrame calls."""
        names = []
        for name in self.MODELS:
            getattr(self, name).createOrReplaceTempView(prefix + name)
            names.append(prefix + name)
        return names

    def build(self, root: str, models=None) -> dict[str, str]:
        """Materialise models as Parquet tables under ``root`` in dependency
        order (K7). Each downstream model then reads the written table, so
        lineage is cut at every table and a lost executor recomputes from
        the last table, not from the raw scan. Overwrite makes a re-run
        idempotent. ``root`` belongs in the shared checkpoint folder."""
        out = {}
        for name in models or self.MODELS:
            path = f"{root.rstrip('/')}/{name}"
            getattr(self, name).write.mode("overwrite").parquet(path)
            self.__dict__[name] = self.t.spark.read.parquet(path)
            out[name] = path
        return out

    def refresh(self, root: str) -> dict[str, str]:
        """Transform, then test (Q4): materialise the models and fail the
        run when a declared data test fails."""
        from paylake.operators import quality
        paths = self.build(root)
        quality.gate(quality.dq_report(self), quality.DECLARED)
        return paths

    MODELS = ("stg_transactions", "stg_clean_transactions", "stg_clients", "stg_countries",
              "stg_transaction_statuses", "stg_transaction_types", "dim_clients",
              "dim_merchants", "dim_location", "dim_date", "fact_transactions",
              "fct_daily_merchant_sales")


class Operations(Warehouse):
    """The models plus the shared intermediate frames of the operators."""

    stored = False    # whether current_transactions is a written table
    pinned: tuple[str, ...] = ()    # raw tables that are read from a written copy

    @cached_property
    def current_transactions(self) -> DataFrame:
        from paylake.operators.recon import current_transactions
        return current_transactions(self.raw.transactions)

    def current(self, *columns: str) -> DataFrame:
        """``txn_id`` and ``columns`` of the current transactions: for readers of few columns."""
        from paylake.operators.recon import current_columns
        if self.stored:
            return self.current_transactions.select("txn_id", *columns)
        among = None if "transactions" in self.pinned else getattr(self.raw, "transactions_among", None)
        return current_columns(self.raw.transactions, *columns, among=among)

    @cached_property
    def flagged(self) -> DataFrame:
        from pyspark.sql import functions as F
        return self.current("client_id", "amount", "channel", "is_international", "is_flagged").filter(F.col("is_flagged") == 1)

    @cached_property
    def settlement_batches(self) -> DataFrame:
        from paylake.operators.recon import settlement_batches
        return settlement_batches(self.current("merchant_id", "initiated_at", "amount", "fee", "status_id"), self.raw.status_lookup)

    def pin(self, *names: str) -> Operations:
        """Write raw tables that are views over joins once, under the shared checkpoint folder,
        and read them from there in everything that is built afterwards: a report over many
        tables derived from one then runs the view's joins once. For stored raw tables
        there is nothing to pin. Call it before the tables that derive from these are used."""
        from paylake.session import shared_dir
        for name in names:
            path = shared_dir(self.t.spark, "paylake", f"pin-{name}-{uuid.uuid4().hex}")
            getattr(self.raw, name).write.parquet(path)
            self.raw.__dict__[name] = self.t.spark.read.schema(getattr(self.raw, name).schema).parquet(path)
            self.pinned += (name,)
        return self

    def bucket_by_txn(self, root: str, buckets: int, prefix: str = "paylake") -> dict[str, DataFrame]:
        """Write current transactions, refunds and alerts as tables bucketed
        and sorted by transaction id under ``root`` (the shared folder).

        Joins between them on the transaction id then read matching buckets
        side by side: no exchange and no sort at query time, however large
        the tables. Rebinds ``current_transactions``; returns the tables."""
        from pyspark.sql import functions as F
        spark = self.t.spark
        frames = {
            "current_transactions": (self.current_transactions, "txn_id"),
            "refunds": (self.raw.refunds, "original_txn_id"),
            "fraud_alerts": (self.raw.fraud_alerts, "txn_id"),
        }
        out = {}
        for name, (df, key) in frames.items():
            table = f"{prefix}_{name}"
            (df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
               .option("path", f"{root.rstrip('/')}/{name}").saveAsTable(table))
            out[name] = spark.table(table)
        self.__dict__["current_transactions"] = out["current_transactions"]
        self.stored = True
        self.__dict__["flagged"] = out["current_transactions"].filter(F.col("is_flagged") == 1)
        return out
