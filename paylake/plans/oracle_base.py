"""DuckDB SQL twin of :mod:`paylake.sources.adapters` and of the models.

The oracle side of every correctness check starts from these CTEs, written
independently of the Spark code in plain SQL. ``with_ctes(names, body)``
prefixes the named CTEs (and their dependencies) to a query body.
"""
from __future__ import annotations

from paylake import schemas as S


def _list(values) -> str:
    out = []
    for v in values:
        out.append(str(v) if isinstance(v, int) else "'" + str(v).replace("'", "''") + "'")
    return "[" + ", ".join(out) + "]"


def _fold(c: str) -> str:
    return (f"(DATE '{S.CALENDAR_START}' + CAST(date_diff('day', DATE '1995-01-01', CAST({c} AS DATE)) "
            f"% 730 AS INTEGER))")


def _secs(day: str, secs: str) -> str:
    return f"(CAST({day} AS TIMESTAMP) + to_seconds(CAST({secs} AS BIGINT)))"


def _status(b: str) -> str:
    return (f"CAST(CASE WHEN {b} < 730 THEN 1 WHEN {b} < 870 THEN 2 WHEN {b} < 950 THEN 6 "
            f"WHEN {b} < 980 THEN 3 WHEN {b} < 995 THEN 5 WHEN {b} < 998 THEN 4 ELSE 7 END AS INTEGER)")


def _channel(b: str) -> str:
    return (f"CASE WHEN {b} < 55 THEN 'POS' WHEN {b} < 80 THEN 'ONLINE' WHEN {b} < 88 THEN 'ATM' "
            f"WHEN {b} < 98 THEN 'MOBILE' ELSE 'IVR' END")


def _rules(amount: str, channel: str, intl: str) -> str:
    R = S.RULE_MAP
    return (f"list_sort(list_distinct(list_concat({_list(R['generic'])}, "
            f"CASE WHEN {amount} > 3000 THEN {_list(R['high_amount'])} ELSE []::VARCHAR[] END, "
            f"CASE WHEN {channel} IN ('ONLINE','MOBILE') THEN {_list(R['online'])} ELSE []::VARCHAR[] END, "
            f"CASE WHEN {intl} = 1 THEN {_list(R['international'])} ELSE []::VARCHAR[] END)))")


def _score(amount: str, jitter: str) -> str:
    return (f"CAST(least(100, CASE WHEN {amount} < 1000 THEN 60 WHEN {amount} < 3000 THEN 75 ELSE 90 END "
            f"+ {jitter}) AS INTEGER)")


CTES: dict[str, tuple[list[str], str]] = {}

CTES["raw_transactions"] = ([], f"""
  j0 AS (
    SELECT l.l_orderkey AS ok, l.l_partkey AS pk, l.l_suppkey, l.l_linenumber AS ln,
           l.l_extendedprice, l.l_returnflag, l.l_shipdate, o.o_custkey, o.o_orderdate,
           l.l_orderkey * 10 + l.l_linenumber AS k,
           CAST(CAST(l.l_extendedprice AS DECIMAL(14,2)) * CAST(0.04 AS DECIMAL(3,2)) AS DECIMAL(14,2)) AS amount0,
           CASE l.l_returnflag WHEN 'A' THEN 'USD' WHEN 'N' THEN 'EUR' ELSE 'GBP' END AS cur0,
           (l.l_orderkey * 7 + l.l_linenumber * 13) % 1000 AS sb,
           (l.l_orderkey * 3 + l.l_linenumber) % 100 AS cb
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
  j1 AS (
    SELECT *,
      {_status('sb')} AS status_id,
      {_channel('cb')} AS channel,
      CASE WHEN ok % 53 = 0 AND ln = 2 THEN NULL
           ELSE {_secs(_fold('o_orderdate'), '(ok * 37 + ln * 600) % 86400')} END AS initiated_at,
      CAST(amount0 * CAST(0.02 AS DECIMAL(3,2)) + CAST(0.10 AS DECIMAL(3,2)) AS DECIMAL(10,2)) AS fee,
      CASE WHEN pk % 29 = 0 THEN -amount0 ELSE amount0 END AS amt
    FROM j0),
  raw_transactions AS (
    SELECT
      CASE WHEN pk % 97 = 0 AND ln = 1 THEN NULL ELSE k END AS txn_id,
      'TXN-' || CAST(ok AS VARCHAR) || '-' || CAST(ln AS VARCHAR) AS reference,
      CASE WHEN ok % 31 = 0 THEN NULL ELSE o_custkey END AS client_id,
      o_custkey * 3 + ln % (o_custkey % 3 + 1) AS card_id,
      CASE WHEN ok % 10 < 7 AND pk % 53 = 0 THEN l_suppkey * 3 + ln % 3 + 900000000
           WHEN ok % 10 < 7 THEN l_suppkey * 3 + ln % 3 END AS pos_id,
      CASE WHEN NOT (ok % 10 < 7) AND pk % 17 = 0 THEN NULL ELSE l_suppkey END AS merchant_id,
      CAST(pk % 7 + 1 AS INTEGER) AS type_id,
      status_id,
      CAST(amt AS DECIMAL(14,2)) AS amount,
      CASE WHEN pk % 41 = 0 THEN NULL WHEN pk % 23 = 0 THEN ' ' || lower(cur0) || ' ' ELSE cur0 END AS currency,
      fee,
      CAST(amt - fee AS DECIMAL(14,2)) AS net_amount,
      CASE WHEN status_id = 1 THEN 'AUTH' || lpad(CAST(k % 1000000 AS VARCHAR), 6, '0') END AS auth_code,
      channel,
      CASE WHEN channel IN ('ONLINE','MOBILE') THEN concat_ws('.', '10', CAST(o_custkey % 256 AS VARCHAR),
           CAST(ln AS VARCHAR), CAST(ok % 256 AS VARCHAR)) END AS ip_address,
      CASE WHEN channel IN ('ONLINE','MOBILE') THEN 'dev-' || CAST(o_custkey AS VARCHAR) || '-'
           || CAST(ok % 4 AS VARCHAR) END AS device_id,
      CASE WHEN ok % 12 = 0 THEN 1 ELSE 0 END AS is_recurring,
      CASE WHEN cur0 <> 'USD' AND pk % 3 = 0 THEN 1 ELSE 0 END AS is_international,
      CASE WHEN amount0 > 2500 AND pk % 5 = 0 THEN 1
           WHEN channel = 'ONLINE' AND pk % 11 = 0 THEN 1 ELSE 0 END AS is_flagged,
      CASE WHEN status_id = 2 THEN list_extract({_list(S.DECLINE_REASONS)}, CAST(k % 6 + 1 AS INTEGER))
           WHEN status_id = 5 THEN list_extract({_list(S.FAIL_REASONS)}, CAST(k % 3 + 1 AS INTEGER)) END
        AS failure_reason,
      initiated_at,
      initiated_at + to_seconds(CAST(k % 8 + 1 AS BIGINT)) AS processed_at,
      CASE WHEN status_id = 6 THEN CAST(initiated_at AS DATE) + CAST(k % 3 + 1 AS INTEGER) END AS settled_at,
      CASE WHEN pk % 43 = 0 THEN NULL ELSE {_secs(_fold('l_shipdate'), 'ln * 60')} END AS created_at
    FROM j1)""")

CTES["raw_clients"] = ([], """
  c0 AS (
    SELECT *, unnest(generate_series(0, CASE WHEN c_custkey % 20 = 5 THEN 2
                                             WHEN c_custkey % 10 = 0 THEN 1 ELSE 0 END)) AS v
    FROM customer),
  c1 AS (
    SELECT *, TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(c_custkey % 365 AS INTEGER)) AS reg0,
           CAST(floor(c_acctbal) AS BIGINT) % 101 AS base_risk,
           'Client.' || CAST(c_custkey AS VARCHAR) || '@Mail.Example' AS email0
    FROM c0),
  c2 AS (
    SELECT *, CASE WHEN v = 2 THEN NULL WHEN v = 1 THEN reg0 + to_days(30) ELSE reg0 END AS registered
    FROM c1),
  raw_clients AS (
    SELECT c_custkey AS client_id,
      CASE WHEN c_custkey % 19 = 0 THEN NULL
           WHEN c_custkey % 19 = 1 THEN '  ' || split_part(c_name, '#', 1) || ' '
           ELSE split_part(c_name, '#', 1) END AS first_name,
      CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE split_part(c_name, '#', 2) END AS last_name,
      CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN v = 1 THEN upper(email0) ELSE email0 END AS email,
      '+1-' || lpad(CAST(c_custkey AS VARCHAR), 7, '0') AS phone,
      'NID' || CAST(c_custkey AS VARCHAR) AS national_id,
      CAST(c_nationkey AS INTEGER) AS country_id,
      c_mktsegment AS city,
      CAST(CASE WHEN c_acctbal < 0 THEN NULL WHEN v = 1 THEN (base_risk + 50) % 101 ELSE base_risk END
           AS INTEGER) AS risk_score,
      CAST(CASE WHEN c_custkey % 9 = 0 THEN 0 WHEN c_custkey % 9 = 1 THEN NULL ELSE 1 END AS INTEGER)
        AS is_active,
      registered AS registered_at,
      coalesce(registered, reg0) AS created_at
    FROM c2)""")

CTES["raw_merchants"] = ([], f"""
  m0 AS (
    SELECT *, unnest(generate_series(0, CASE WHEN s_suppkey % 25 = 3 THEN 1 ELSE 0 END)) AS v
    FROM supplier),
  raw_merchants AS (
    SELECT s_suppkey AS merchant_id, s_name AS legal_name,
      CASE WHEN s_suppkey % 17 = 0 THEN NULL
           WHEN s_suppkey % 2 = 0 THEN lower(replace(s_name, '#', '-')) || ' o''shop'
           ELSE replace(s_name, '#', ' ') || ' LLC' END AS trade_name,
      CAST(CASE WHEN s_suppkey % 16 = 15 THEN NULL
           ELSE list_extract({_list([m for m, _ in S.MERCHANT_CATEGORIES])}, CAST(s_suppkey % 15 + 1 AS INTEGER))
           END AS INTEGER) AS mcc,
      'TAX' || CAST(s_suppkey AS VARCHAR) AS tax_id,
      CAST(CASE WHEN s_suppkey % 31 = 30 THEN 99 ELSE s_nationkey END AS INTEGER) AS country_id,
      CAST(CASE WHEN s_acctbal < 0 THEN 0 ELSE 1 END AS INTEGER) AS is_active,
      TIMESTAMP '2023-01-01 00:00:00' + to_days(CAST(s_suppkey % 365 AS INTEGER)) AS onboarded_at,
      CASE WHEN s_suppkey % 19 = 7 THEN NULL
           ELSE TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(s_suppkey % 365 + v AS INTEGER)) END AS created_at
    FROM m0)""")

_NAMES = _list([n for _, n, _ in S.COUNTRIES])
_CURS = _list([c for _, _, c in S.COUNTRIES])
_CODES = _list([c for c, _, _ in S.COUNTRIES])

CTES["raw_countries"] = ([], f"""
  n0 AS (
    SELECT n.n_nationkey AS nk, n.n_name, n.n_regionkey, r.r_name,
           unnest(generate_series(0, CASE WHEN n.n_regionkey IN (2, 3) THEN 1 ELSE 0 END)) AS v
    FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey),
  n1 AS (
    SELECT *, CASE WHEN nk < 10 THEN list_extract({_NAMES}, CAST(nk + 1 AS INTEGER)) ELSE n_name END AS name0
    FROM n0),
  raw_countries AS (
    SELECT CAST(nk AS INTEGER) AS country_id,
      CASE WHEN nk < 10 THEN list_extract({_CODES}, CAST(nk + 1 AS INTEGER))
           ELSE 'C' || lpad(CAST(nk AS VARCHAR), 2, '0') END AS code,
      CASE WHEN v = 0 THEN (CASE WHEN nk % 12 = 11 THEN NULL
                                 WHEN nk % 6 = 4 THEN '  ' || lower(name0) || ' ' ELSE name0 END)
           WHEN n_regionkey = 2 THEN 'zz ' || name0 ELSE NULL END AS name,
      CASE WHEN nk % 8 = 7 THEN NULL WHEN nk < 10 THEN list_extract({_CURS}, CAST(nk + 1 AS INTEGER))
           ELSE lower(substring(r_name, 1, 3)) END AS currency,
      TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(nk + v AS INTEGER)) AS created_at
    FROM n1)""")

_STATUS_ROWS = ", ".join(f"({i}, '{c}', '{l}')" for i, c, l in S.TRANSACTION_STATUSES)
_TYPE_ROWS = ", ".join(f"({i}, '{c}', '{l}', {d})" for i, c, l, d in S.TRANSACTION_TYPES)
_MCC_ROWS = ", ".join("({}, '{}')".format(m, d.replace("'", "''")) for m, d in S.MERCHANT_CATEGORIES)
_NET_ROWS = ", ".join(f"({i}, '{n}', '{r}')" for i, n, r in S.CARD_NETWORKS)

CTES["raw_transaction_statuses"] = (["raw_transactions"], f"""
  raw_transaction_statuses AS (
    SELECT CAST(status_id AS INTEGER) AS status_id, code, label
    FROM (VALUES {_STATUS_ROWS}) v(status_id, code, label)
    WHERE status_id IN (SELECT status_id FROM raw_transactions))""")

CTES["raw_transaction_types"] = (["raw_transactions"], f"""
  raw_transaction_types AS (
    SELECT CAST(type_id AS INTEGER) AS type_id, code, label, CAST(is_debit AS INTEGER) AS is_debit
    FROM (VALUES {_TYPE_ROWS}) v(type_id, code, label, is_debit)
    WHERE type_id IN (SELECT type_id FROM raw_transactions))""")

CTES["raw_merchant_categories"] = ([], f"""
  raw_merchant_categories AS (
    SELECT CAST(mcc AS INTEGER) AS mcc, description FROM (VALUES {_MCC_ROWS}) v(mcc, description))""")

CTES["raw_card_networks"] = ([], f"""
  raw_card_networks AS (
    SELECT CAST(network_id AS INTEGER) AS network_id, name, prefix_regex
    FROM (VALUES {_NET_ROWS}) v(network_id, name, prefix_regex))""")

CTES["raw_pos_terminals"] = ([], """
  raw_pos_terminals AS (
    SELECT s_suppkey * 3 + k AS pos_id,
      'SN' || lpad(CAST(s_suppkey * 3 + k AS VARCHAR), 8, '0') AS serial_number,
      s_suppkey AS merchant_id,
      CASE WHEN k = 0 THEN 'A920' WHEN k = 1 THEN 'Move5000' ELSE 'V240m' END AS model,
      1 AS is_active,
      TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(s_suppkey % 365 AS INTEGER)) AS created_at
    FROM (SELECT s_suppkey, unnest(generate_series(0, 2)) AS k FROM supplier))""")

CTES["raw_payment_cards"] = ([], """
  raw_payment_cards AS (
    SELECT c_custkey * 3 + k AS card_id, c_custkey AS client_id,
      CAST((c_custkey * 3 + k) % 4 + 1 AS INTEGER) AS network_id,
      '************' || lpad(CAST((c_custkey * 3 + k) % 10000 AS VARCHAR), 4, '0') AS masked_pan,
      'tok_' || CAST(c_custkey * 3 + k AS VARCHAR) AS card_token,
      c_name AS holder_name,
      CAST((c_custkey * 3 + k) % 12 + 1 AS INTEGER) AS expiry_month,
      CAST((c_custkey * 3 + k) % 4 + 2026 AS INTEGER) AS expiry_year,
      CASE WHEN k = 0 OR (c_custkey % 37 = 0 AND k = 1) THEN 1 ELSE 0 END AS is_default,
      1 AS is_active,
      TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(c_custkey % 365 AS INTEGER)) AS created_at
    FROM (SELECT c_custkey, c_name, unnest(generate_series(0, c_custkey % 3)) AS k FROM customer))""")

CTES["raw_refunds"] = (["raw_transactions"], f"""
  raw_refunds AS (
    SELECT txn_id AS refund_id, txn_id AS original_txn_id,
      'RFD-' || CAST(txn_id AS VARCHAR) AS reference,
      CAST(CASE WHEN txn_id % 10 < 3 THEN CAST(abs(amount) * CAST(0.5 AS DECIMAL(2,1)) AS DECIMAL(14,2))
                ELSE abs(amount) END AS DECIMAL(14,2)) AS amount,
      list_extract({_list(S.REFUND_REASONS)}, CAST(txn_id % 6 + 1 AS INTEGER)) AS reason,
      CAST(CASE WHEN txn_id % 23 = 0 THEN 4 ELSE 1 END AS INTEGER) AS status_id,
      initiated_at + to_days(CAST(txn_id % 30 AS INTEGER)) AS initiated_at,
      initiated_at + to_days(CAST(txn_id % 30 AS INTEGER)) + to_hours(CAST(txn_id % 72 + 1 AS BIGINT))
        AS resolved_at,
      created_at
    FROM raw_transactions
    WHERE status_id = 1 AND txn_id IS NOT NULL AND txn_id % 19 = 0)""")

CTES["raw_fraud_alerts"] = (["raw_transactions"], f"""
  fa0 AS (
    SELECT *, unnest(generate_series(0, txn_id % 3)) AS i,
           {_rules('abs(amount)', 'channel', 'is_international')} AS pool
    FROM raw_transactions WHERE is_flagged = 1 AND txn_id IS NOT NULL),
  raw_fraud_alerts AS (
    SELECT txn_id * 10 + i AS alert_id, txn_id,
      list_extract(pool, CAST((txn_id + i) % len(pool) + 1 AS INTEGER)) AS rule_triggered,
      {_score('abs(amount)', '(txn_id % 16) - 5')} AS risk_score,
      CASE WHEN (txn_id + i) % 10 < 7 THEN (CASE WHEN (txn_id + i) % 5 < 2 THEN 1 ELSE 0 END) END AS is_confirmed,
      CASE WHEN (txn_id + i) % 10 < 7 THEN 'analyst_' || CAST((txn_id + i) % 9 AS VARCHAR) END AS reviewed_by,
      CASE WHEN (txn_id + i) % 10 < 7 THEN initiated_at + to_days(CAST(txn_id % 7 + 1 AS INTEGER)) END
        AS reviewed_at,
      processed_at AS created_at
    FROM fa0)""")

CTES["live_transactions"] = ([], """
  e0 AS (
    SELECT *, CAST(CAST(value AS DECIMAL(12,2)) * 20 AS DECIMAL(14,2)) AS amount0,
      CASE WHEN event_type IN ('click', 'signup') THEN 'ONLINE' WHEN event_type = 'view' THEN 'MOBILE'
           WHEN event_type = 'purchase' THEN 'POS' ELSE 'ATM' END AS channel0,
      CASE WHEN event_id % 20 < 10 THEN 'USD' WHEN event_id % 20 < 13 THEN 'EUR'
           WHEN event_id % 20 < 15 THEN 'GBP' WHEN event_id % 20 < 17 THEN 'EGP'
           WHEN event_id % 20 = 17 THEN 'SAR' WHEN event_id % 20 = 18 THEN 'AED' ELSE 'CAD' END AS cur0,
      'd' || json_extract_string(props, '$.k') AS device0,
      event_id % 200 AS kind
    FROM events),
  e_camp AS (
    SELECT *, unnest(generate_series(0, CASE WHEN kind = 0 THEN 11 WHEN kind = 1 THEN 5
                                             WHEN kind = 3 THEN 1 ELSE 0 END)) AS i
    FROM e0 WHERE kind < 5),
  live_transactions AS (
    SELECT event_id * 100 AS txn_id, user_id AS client_id, amount0 AS amount, cur0 AS currency,
      channel0 AS channel, CASE WHEN cur0 <> 'USD' AND event_id % 3 = 0 THEN 1 ELSE 0 END AS is_international,
      device0 AS device_id, ts AS initiated_at
    FROM e0
    UNION ALL
    SELECT event_id * 100 + 1 + i AS txn_id, user_id AS client_id,
      CAST(CASE WHEN kind = 0 THEN CAST(0.5 AS DECIMAL(14,2)) + CAST(i AS DECIMAL(14,2)) * CAST(0.1 AS DECIMAL(3,2))
                WHEN kind = 1 THEN amount0 + 200
                WHEN kind = 2 THEN CAST(value AS DECIMAL(12,2)) * 10 + 500
                WHEN kind = 3 THEN CAST(value AS DECIMAL(12,2)) + 100
                ELSE CAST(value AS DECIMAL(12,2)) * 10 + 3000 END AS DECIMAL(14,2)) AS amount,
      CASE WHEN kind = 0 THEN 'USD' WHEN kind = 1 THEN list_extract(['EUR', 'GBP', 'AED'], CAST(i % 3 + 1 AS INTEGER))
           WHEN kind = 2 THEN 'EUR' WHEN kind = 3 THEN 'USD' ELSE 'GBP' END AS currency,
      CASE WHEN kind = 3 AND i = 1 THEN 'MOBILE' ELSE 'ONLINE' END AS channel,
      CASE WHEN kind IN (1, 2, 4) THEN 1 ELSE 0 END AS is_international,
      CASE WHEN kind = 2 THEN 'new-' || CAST(event_id AS VARCHAR) ELSE device0 END AS device_id,
      CASE WHEN kind = 0 THEN ts + to_seconds(CAST(i * 20 AS BIGINT))
           WHEN kind = 1 THEN ts + to_minutes(CAST(i * 10 AS BIGINT))
           WHEN kind = 2 THEN ts + to_minutes(1)
           WHEN kind = 3 THEN CAST(CAST(ts AS DATE) AS TIMESTAMP) + to_seconds(CAST(7200 + i * 900 AS BIGINT))
           ELSE ts + to_minutes(2) END AS initiated_at
    FROM e_camp)""")


def register(name: str, deps: list[str], sql: str) -> None:
    CTES[name] = (deps, sql)


def with_ctes(names: list[str], body: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][0]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    return "WITH " + ",".join(CTES[n][1] for n in order) + "\n" + body


def latest_sql(name: str, src: str, key: str, order: str, cols: list[str], where: str = "TRUE") -> str:
    """CTE text: first row per ``key`` under ``order``, other columns as
    descending NULLS LAST tie-breaks."""
    ties = ", ".join(f"{c} DESC NULLS LAST" for c in cols if c != key)
    sel = ", ".join(cols)
    return (f"\n  {name} AS (SELECT {sel} FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY {key} "
            f"ORDER BY {order}, {ties}) AS rn FROM {src} WHERE {where}) WHERE rn = 1)")
