"""Compare a Spark result with a DuckDB oracle on the same parquet tables.

Mirrors the driver's gate: row count, column names, and an order-insensitive
comparison of the values (columns sorted by name, rows sorted).
"""
from __future__ import annotations

import datetime as dt
import decimal
import math

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def duck_connect(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float) and math.isnan(v):
        return (0, "")
    if isinstance(v, bool):
        return (1, str(v))
    if isinstance(v, (int, decimal.Decimal, float)):
        d = decimal.Decimal(str(v)) if isinstance(v, float) else decimal.Decimal(v)
        return (2, format(d.normalize(), "f") if d == d else "nan")
    if isinstance(v, dt.datetime):
        return (3, v.replace(tzinfo=None).isoformat())
    if isinstance(v, dt.date):
        return (3, v.isoformat())
    if isinstance(v, (list, tuple)):
        return (4, repr([_norm(x) for x in v]))
    return (5, str(v))


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark_df, sql: str, con) -> dict:
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    rel = con.sql(sql)
    d_cols = rel.columns
    d_rows = rel.fetchall()
    out = {"spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "schema_match": sorted(s_cols) == sorted(d_cols)}
    if not out["schema_match"]:
        out["spark_cols"], out["oracle_cols"] = sorted(s_cols), sorted(d_cols)
        out["match"] = False
        return out
    a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
    out["match"] = a == b
    if not out["match"]:
        sa, sb = set(a), set(b)
        out["only_spark"] = sorted(sa - sb)[:3]
        out["only_oracle"] = sorted(sb - sa)[:3]
    return out
