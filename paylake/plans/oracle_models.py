"""DuckDB text of the staging and mart models (oracle side)."""
from __future__ import annotations

from paylake import schemas as S
from paylake.plans.oracle_base import register

WORD_OR_GAP = r"[\p{L}\p{N}]+|[^\p{L}\p{N}]+"


def initcap(x: str) -> str:
    return (f"array_to_string(list_transform(regexp_extract_all(lower({x}), '{WORD_OR_GAP}', 0), "
            f"lambda w: upper(substr(w, 1, 1)) || substr(w, 2)), '')")


def _in(values) -> str:
    return "(" + ", ".join("'" + v + "'" for v in values) + ")"


# The staging models pick one version per key by the greatest sort key (arg_max over rows);
# a missing time is the latest, any other missing value the least. Defaults come from a one-row table.

def _least_if_null(c: str, stand_in: str) -> str:
    return f"{c} NOTNULL, ifnull({c}, {stand_in})"


register("stg_transactions", ["raw_transactions"], f"""
  txn_default(id, code) AS (VALUES ({S.UNKNOWN_ID}, '{S.DEFAULT_CURRENCY}')),
  txn_version AS (
    SELECT t.txn_id, ifnull(t.created_at, 'infinity'::TIMESTAMP) AS latest,
      {{'client': ifnull(t.client_id, d.id), 'merchant': ifnull(t.merchant_id, d.id), 'amount': greatest(t.amount, -t.amount),
        'currency': ifnull(upper(trim(t.currency)), d.code), 'started': t.initiated_at, 'created': t.created_at}} AS v
    FROM raw_transactions t, txn_default d WHERE t.txn_id NOTNULL AND t.initiated_at NOTNULL),
  txn_pick AS (
    SELECT txn_id, arg_max(v, (latest, v.client, v.merchant, {_least_if_null("v.amount", "0")}, v.currency, v.started)) AS v
    FROM txn_version GROUP BY txn_id),
  stg_transactions AS (
    SELECT txn_id AS transaction_id, v.client AS client_id, v.merchant AS merchant_id, v.amount, v.currency,
      v.started AS initiated_at_timestamp, v.created AS created_at_timestamp
    FROM txn_pick)""")

# what staging lets through is clean already
register("stg_clean_transactions", ["stg_transactions"], """
  stg_clean_transactions AS (SELECT * EXCLUDE (created_at_timestamp) FROM stg_transactions)""")

register("stg_clients", ["raw_clients"], f"""
  client_pick AS (
    SELECT client_id, arg_max(v, (ifnull(v.since, 'infinity'::TIMESTAMP), {_least_if_null("v.first", "''")},
        {_least_if_null("v.last", "''")}, v.email, {_least_if_null("v.country", "0")}, {_least_if_null("v.risk", "0")}, v.active)) AS v
    FROM (SELECT client_id, {{'first': trim(first_name), 'last': trim(last_name),
            'email': ifnull(lower(email), '{S.MISSING_EMAIL_STAGING}'), 'country': country_id, 'risk': risk_score,
            'active': is_active IS NOT DISTINCT FROM 1, 'since': registered_at}} AS v FROM raw_clients)
    GROUP BY client_id),
  stg_clients AS (
    SELECT client_id, v.first AS first_name, v.last AS last_name, v.email, v.country AS country_id, v.risk AS risk_score,
      v.active AS is_active, v.since AS registered_at
    FROM client_pick)""")

# the first name in order, then the last currency among the versions of that name
register("stg_countries", ["raw_countries"], f"""
  country_version AS (
    SELECT country_id, {initcap('trim(name)')} AS name, ifnull(upper(trim(currency)), 'UNKNOWN') AS code FROM raw_countries),
  country_name AS (SELECT country_id, min(name) AS name FROM country_version GROUP BY country_id),
  stg_countries AS (
    SELECT n.country_id, n.name AS country_name, max(v.code) AS local_currency
    FROM country_name n JOIN country_version v
      ON v.country_id IS NOT DISTINCT FROM n.country_id AND v.name IS NOT DISTINCT FROM n.name
    GROUP BY n.country_id, n.name)""")

register("stg_transaction_statuses", ["raw_transaction_statuses"], """
  stg_transaction_statuses AS (
    SELECT status_id, ifnull(upper(trim(label)), 'UNKNOWN') AS status_name FROM raw_transaction_statuses)""")

register("stg_transaction_types", ["raw_transaction_types"], """
  stg_transaction_types AS (
    SELECT type_id, ifnull(upper(trim(label)), 'UNKNOWN') AS type_name, is_debit IS NOT DISTINCT FROM 1 AS is_debit_type
    FROM raw_transaction_types)""")

# The dimensions classify by joining rule tables (lowest and highest value, or name, to
# class) and take the unknown member from a one-row table.

def _rules(name: str, columns: str, rows: list[tuple]) -> str:
    return f"{name}({columns}) AS (VALUES " + ", ".join(
        "(" + ", ".join("'" + str(v) + "'" if isinstance(v, str) else str(v) for v in row) + ")" for row in rows) + ")"


_REGIONS = [(c, r) for r, names in (("Middle East", S.MIDDLE_EAST), ("Africa", S.AFRICA), ("Europe", S.EUROPE)) for c in names]

register("dim_clients", ["stg_clients"], f"""
  {_rules("risk_rule", "lowest, highest, class", [(-2147483648, 50, 'Low Risk'), (51, 80, 'Medium Risk'),
                                                  (81, 2147483647, 'High Risk')])},
  dim_clients AS (
    SELECT c.client_id, CASE n.shown WHEN '' THEN 'Unknown Name' ELSE n.shown END AS full_name,
      ifnull(c.email, '{S.MISSING_EMAIL_MART}') AS email, ifnull(r.class, 'Unrated') AS risk_category,
      c.is_active, c.registered_at
    FROM stg_clients c
    JOIN LATERAL (SELECT trim(concat_ws(' ', c.first_name, c.last_name)) AS shown) n ON true
    LEFT JOIN risk_rule r ON c.risk_score BETWEEN r.lowest AND r.highest
    UNION ALL BY NAME
    SELECT -1 AS client_id, 'Unknown Client' AS full_name, '{S.MISSING_EMAIL_MART}' AS email,
      'Unrated' AS risk_category, false AS is_active)""")

register("dim_merchants", ["raw_merchants"], f"""
  {_rules("mcc_rule", "mcc, class", S.MCC_GROUPS)},
  dim_merchants AS (
    SELECT m.merchant_id, ifnull({initcap('m.trade_name')}, 'Unknown Merchant') AS merchant_name,
      m.mcc AS merchant_category_code, ifnull(g.class, 'OTHER') AS merchant_category_group,
      m.created_at AS merchant_onboarded_at
    FROM raw_merchants m LEFT JOIN mcc_rule g USING (mcc)
    UNION ALL BY NAME
    SELECT -1 AS merchant_id, 'Unknown Merchant' AS merchant_name, 'OTHER' AS merchant_category_group)""")

register("dim_location", ["stg_countries"], f"""
  {_rules("region_rule", "country_name, class", _REGIONS)},
  dl_named AS (
    SELECT c.country_id, {initcap('c.country_name')} AS country_name, ifnull(upper(c.local_currency), 'N/A') AS local_currency,
      ifnull(r.class, 'Other') AS region
    FROM stg_countries c LEFT JOIN region_rule r USING (country_name)),
  dim_location AS (
    SELECT md5(array_to_string([ifnull(x, '{S.SURROGATE_NULL}') FOR x IN [country_id::VARCHAR, country_name]], '-')) AS location_key,
      country_id, country_name, local_currency, region
    FROM dl_named
    UNION ALL BY NAME
    SELECT 'unknown' AS location_key, -1 AS country_id, 'Unknown Country' AS country_name, 'N/A' AS local_currency,
      'Unknown Region' AS region)""")

register("fact_transactions", ["stg_clean_transactions"], """
  fact_transactions AS (
    SELECT *, initiated_at_timestamp::DATE AS date_key FROM stg_clean_transactions)""")

register("dim_date", ["raw_transactions"], f"""
  dd_bounds AS (
    SELECT COALESCE(least(DATE '{S.CALENDAR_START}', min(CAST(initiated_at AS DATE))), DATE '{S.CALENDAR_START}') AS lo,
           COALESCE(greatest(DATE '{S.CALENDAR_END}', max(CAST(initiated_at AS DATE))), DATE '{S.CALENDAR_END}') AS hi
    FROM raw_transactions),
  dd_series AS (
    SELECT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS d
    FROM dd_bounds),
  dim_date AS (
    SELECT d AS date_key, CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
      CAST(day(d) AS INTEGER) AS day, rpad(monthname(d), 9, ' ') AS month_name,
      rpad(dayname(d), 9, ' ') AS day_name,
      CASE WHEN isodow(d) IN (5, 6) THEN 'Weekend' ELSE 'Weekday' END AS day_type,
      'Q' || CAST(quarter(d) AS VARCHAR) AS quarter
    FROM dd_series)""")

register("fct_daily_merchant_sales", ["fact_transactions"], """
  fct_daily_merchant_sales AS (
    SELECT date_key AS transaction_date, merchant_id, currency,
      COUNT(transaction_id) AS total_transaction_count,
      SUM(amount) AS daily_total_amount,
      ROUND(CAST(CAST(SUM(amount) AS DOUBLE) / COUNT(amount) AS DECIMAL(18,6)), 2) AS avg_transaction_value
    FROM fact_transactions
    GROUP BY 1, 2, 3)""")
