"""Data-quality checks and the gate that runs them.

Every check returns a DataFrame; a report row is one check with its number
of failures. Reports over several tables are compiled by :mod:`checks`: one scan per
table, one shuffle for all checks. Checks on one model alone are a single aggregate
(:func:`column_checks`).
"""
from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylake import schemas as S
from paylake.operators.checks import Foreign, Plan, Rule, Unique

REPORT_COLS = ["check_name", "model", "column_name", "failures"]


def _union(dfs: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), dfs)


def column_checks(df: DataFrame, model: str, checks: Sequence[tuple[str, str, Column]]) -> DataFrame:
    """Fold ``(check_name, column, failing_predicate)`` checks into one
    aggregate over ``df`` and return one report row per check."""
    aggs = [F.sum(F.when(pred, 1).otherwise(0)).cast("bigint").alias(f"c{i}")
            for i, (_, _, pred) in enumerate(checks)]
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(name).alias("check_name"), F.lit(model).alias("model"),
                     F.lit(col).alias("column_name"),
                     F.coalesce(F.col(f"c{i}"), F.lit(0).cast("bigint")).alias("failures"))
            for i, (name, col, _) in enumerate(checks)]
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def not_null(col: str) -> tuple[str, str, Column]:
    return ("not_null", col, F.col(col).isNull())


def accepted_range(col: str, min_value=None, max_value=None) -> tuple[str, str, Column]:
    """Inclusive bounds; a NULL value passes."""
    fail = F.lit(False)
    if min_value is not None:
        fail = fail | (F.col(col) < min_value)
    if max_value is not None:
        fail = fail | (F.col(col) > max_value)
    return ("accepted_range", col, F.coalesce(fail, F.lit(False)))


def accepted_values(col: str, values: Sequence) -> tuple[str, str, Column]:
    return ("accepted_values", col, F.col(col).isNotNull() & ~F.col(col).isin(*values))


# -- the declared tests of the models ------------------------------------

STAGING_KEYS = [("stg_clients", "client_id"), ("stg_transactions", "transaction_id"), ("stg_countries", "country_id"),
                ("stg_transaction_statuses", "status_id"), ("stg_transaction_types", "type_id")]
DECLARED = STAGING_KEYS + [("fact_transactions", "amount")]


def declared_tests() -> list:
    """unique + not_null on the five staging keys, not_null and min 0 on the
    fact amount."""
    out = []
    for model, key in STAGING_KEYS:
        out += [Unique(model, (key,)), rule(model, not_null(key))]
    return out + [rule("fact_transactions", c) for c in (not_null("amount"), accepted_range("amount", min_value=0))]


def rule(table: str, check: tuple[str, str, Column]) -> Rule:
    return Rule(check[0], table, check[1], check[2])


# -- source constraints --------------------------------------------------

SOURCE_UNIQUE = [
    ("transactions", ["txn_id"]), ("transactions", ["reference"]),
    ("clients", ["client_id"]), ("clients", ["email"]), ("clients", ["national_id"]),
    ("merchants", ["merchant_id"]), ("merchants", ["tax_id"]),
    ("countries", ["country_id"]), ("countries", ["code"]),
    ("payment_cards", ["card_token"]), ("pos_terminals", ["serial_number"]),
    ("refunds", ["reference"]), ("transaction_types", ["code"]), ("transaction_statuses", ["code"]),
    ("card_networks", ["name"]), ("settlement_batches", ["merchant_id", "batch_date"]),
]


def source_tests() -> list:
    out: list = [Unique(t, tuple(keys)) for t, keys in SOURCE_UNIQUE]
    out += [rule("transactions", c) for c in (
        not_null("txn_id"), not_null("initiated_at"), accepted_range("amount", min_value=0),
        accepted_values("channel", S.CHANNELS), accepted_values("currency", S.CURRENCIES))]
    return out + [rule("settlement_batches", accepted_values("status", S.BATCH_STATUSES))]


def relationship_tests(fks=S.FOREIGN_KEYS) -> list:
    """One ``relationships`` check per declared foreign key (Q9)."""
    return [Foreign(*fk) for fk in fks]


def tables_of(wh, checks) -> dict[str, DataFrame]:
    """The tables that checks name: models, then the settlement batches, then raw tables."""
    names = {t for c in checks for t in ((c.child, c.parent) if isinstance(c, Foreign) else (c.table,))}
    return {n: getattr(wh, n) if n in wh.MODELS or n == "settlement_batches" else getattr(wh.raw, n) for n in sorted(names)}


def compiled(wh, checks) -> Plan:
    return Plan(checks, tables_of(wh, checks))


def dq_report(wh, relationships: bool = False) -> DataFrame:
    """All declared and source checks, one row each (the gate's input);
    with ``relationships`` also one row per foreign key."""
    checks = declared_tests() + source_tests() + (relationship_tests() if relationships else [])
    return compiled(wh, checks).report().select(*REPORT_COLS)


def unique_keys(wh) -> DataFrame:
    """One row per duplicated key of the staging models and the sources' unique constraints."""
    checks = [Unique(m, (k,)) for m, k in STAGING_KEYS] + [Unique(t, tuple(keys)) for t, keys in SOURCE_UNIQUE]
    return compiled(wh, checks).duplicates()


def duplicate_keys(df: DataFrame, model: str, keys: Sequence[str]) -> DataFrame:
    """One row per key value that occurs more than once (NULL keys ignored)."""
    return Plan([Unique(model, tuple(keys))], {model: df}).duplicates()


def gate(report: DataFrame, checks: Sequence[tuple[str, str]] | None = None) -> None:
    """Fail the run when a declared check has failures.

    The report has one row per check -- bounded by the number of checks, not
    by the data -- so reading it on the driver is safe."""
    failing = report.filter(F.col("failures") > 0)
    if checks is not None:
        keep = F.lit(False)
        for model, col in checks:
            keep = keep | ((F.col("model") == model) & (F.col("column_name") == col))
        failing = failing.filter(keep)
    bad = failing.collect()
    if bad:
        raise AssertionError("data tests failed: " + ", ".join(
            f"{r.check_name}({r.model}.{r.column_name})={r.failures}" for r in bad))


def non_empty(tables: dict[str, DataFrame]) -> DataFrame:
    """Whether each lookup table has at least one row.

    ``limit(1)`` per table: each scan stops at its first row."""
    probes = [df.limit(1).select(F.lit(name).alias("table_name")) for name, df in tables.items()]
    present = _union(probes)
    names = present.sparkSession.createDataFrame([(n,) for n in tables], "table_name string")
    return (names.join(present.withColumn("has_rows", F.lit(True)), "table_name", "left")
                 .select("table_name", F.coalesce("has_rows", F.lit(False)).alias("has_rows")))


def bad_values(df: DataFrame, model: str, accepted: dict[str, Sequence]) -> DataFrame:
    """One row per value outside a column's accepted set, with its count; one pass for all columns."""
    entries = [F.when(F.col(c).isNotNull() & ~F.col(c).isin(*values),
                      F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")))
               for c, values in accepted.items()]
    return (df.select(F.explode(F.filter(F.array(*entries), lambda e: e.isNotNull())).alias("e"))
              .groupBy("e.column_name", "e.value").count()
              .select(F.lit(model).alias("model"), "column_name", "value", F.col("count").alias("failures")))


def fill_defaults(df: DataFrame, defaults: dict) -> DataFrame:
    """Apply the DDL column defaults to NULLs (``na.fill`` per column)."""
    return df.select(*[F.coalesce(F.col(c), F.lit(defaults[c]).cast(df.schema[c].dataType)).alias(c)
                       if c in defaults else F.col(c) for c in df.columns])


def row_rules(txn: DataFrame) -> DataFrame:
    """Violations of the implied per-row rules of a transaction."""
    st, ch = F.col("status_id"), F.col("channel")
    amt = F.abs(F.col("amount"))
    delay = F.col("processed_at").cast("timestamp").cast("long") - F.col("initiated_at").cast("timestamp").cast("long")
    settle_days = F.datediff(F.col("settled_at"), F.col("initiated_at").cast("date"))
    return column_checks(txn, "transactions", [
        ("auth_code_iff_approved", "auth_code", F.col("auth_code").isNotNull() != (st == 1)),
        ("reason_iff_declined_or_failed", "failure_reason",
         F.col("failure_reason").isNotNull() != st.isin(2, 5)),
        ("settled_iff_settled", "settled_at", F.col("settled_at").isNotNull() != (st == 6)),
        ("settled_1_to_3_days", "settled_at", F.coalesce(~settle_days.between(1, 3), F.lit(False))),
        ("device_only_online", "device_id", F.col("device_id").isNotNull() & ~ch.isin("ONLINE", "MOBILE")),
        ("ip_iff_online", "ip_address", F.col("ip_address").isNotNull() != ch.isin("ONLINE", "MOBILE")),
        ("processed_1_to_8_s", "processed_at", F.coalesce(~delay.between(1, 8), F.lit(False))),
        ("fee_in_band", "fee", F.coalesce(~F.col("fee").between(amt * 0.015 + 0.10, amt * 0.03 + 0.50),
                                          F.lit(False))),
        ("net_is_amount_minus_fee", "net_amount",
         F.coalesce(F.col("net_amount") != F.col("amount") - F.col("fee"), F.lit(False))),
    ])


def default_card_violations(cards: DataFrame) -> DataFrame:
    """Clients whose number of default cards is not exactly one."""
    return (cards.groupBy("client_id")
                 .agg(F.sum("is_default").cast("bigint").alias("default_cards"))
                 .filter(F.col("default_cards") != 1))


def fk_orphans(raw, fks=S.FOREIGN_KEYS, tables: dict | None = None) -> DataFrame:
    """Number of child rows whose non-null key has no parent, per FK."""
    names = {t for child, _, parent, _ in fks for t in (child, parent)}
    found = {n: (tables or {}).get(n) if n in (tables or {}) else getattr(raw, n) for n in names}
    return Plan(relationship_tests(fks), found).orphans()
