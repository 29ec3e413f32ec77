"""Hand-made edge rows (FIXTURES.md section 4) through the models."""
import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from paylake import schemas as S
from paylake.operators import marts, staging

TS = dt.datetime


def _txn(spark, rows):
    cols = ["txn_id", "client_id", "merchant_id", "amount", "currency", "initiated_at", "created_at"]
    full = [{f.name: None for f in S.RAW_SCHEMAS["transactions"].fields} | dict(zip(cols, r)) for r in rows]
    return spark.createDataFrame(full, S.RAW_SCHEMAS["transactions"])


def test_transaction_dedup_and_cleaning(spark):
    raw = _txn(spark, [
        (1, 5, 7, Decimal("10.00"), "USD", TS(2025, 3, 1, 9), TS(2025, 3, 1, 10, 0, 5)),   # E1 older
        (1, 5, 7, Decimal("11.00"), "USD", TS(2025, 3, 1, 9), None),                       # E1 null wins
        (2, 5, 7, Decimal("1.00"), "USD", TS(2025, 3, 1, 9), TS(2025, 3, 1)),              # E2 survives
        (2, 5, 7, Decimal("2.00"), "USD", None, TS(2025, 3, 2)),                           # E2 no time
        (None, 5, 7, Decimal("3.00"), "USD", TS(2025, 3, 1), TS(2025, 3, 1)),              # E3 dropped
        (4, None, None, Decimal("-12.50"), None, TS(2025, 3, 1), TS(2025, 3, 1)),          # E4
        (5, 1, 1, Decimal("1.00"), " usd ", TS(2025, 3, 1), TS(2025, 3, 1)),               # E5
        (6, 1, 1, Decimal("1.00"), "  ", TS(2025, 3, 1), TS(2025, 3, 1)),                  # E5 blank
    ])
    out = {r.transaction_id: r for r in staging.stg_transactions(raw).collect()}
    assert set(out) == {1, 2, 4, 5, 6}
    assert out[1].amount == Decimal("11.00")
    assert out[2].amount == Decimal("1.00")
    assert (out[4].client_id, out[4].merchant_id, out[4].currency, out[4].amount) == (-1, -1, "EGP", Decimal("12.50"))
    assert out[5].currency == "USD"
    assert out[6].currency == ""


def test_clients_and_dim(spark):
    schema = S.RAW_SCHEMAS["clients"]
    base = {f.name: None for f in schema.fields}
    rows = [
        base | dict(client_id=1, first_name=" Ana ", last_name=None, email="A@B.C", risk_score=81, is_active=1,
                    registered_at=TS(2024, 1, 1)),
        base | dict(client_id=1, first_name=" Ana ", last_name=None, email="A@B.C", risk_score=81, is_active=1,
                    registered_at=TS(2024, 6, 1)),
        base | dict(client_id=2, first_name=None, last_name=None, email=None, risk_score=80, is_active=0),
        base | dict(client_id=3, first_name="", last_name=None, risk_score=51, is_active=None,
                    registered_at=TS(2024, 1, 1)),
        base | dict(client_id=4, first_name="x", last_name="y", risk_score=50, registered_at=TS(2024, 1, 1)),
        base | dict(client_id=5, first_name="x", last_name="y", risk_score=None, registered_at=TS(2024, 1, 1)),
    ]
    stg = staging.stg_clients(spark.createDataFrame(rows, schema))
    s = {r.client_id: r for r in stg.collect()}
    assert s[1].registered_at == TS(2024, 6, 1)                                   # E10
    assert s[1].email == "a@b.c" and s[2].email == S.MISSING_EMAIL_STAGING       # E7
    assert (s[1].is_active, s[2].is_active, s[3].is_active) == (True, False, False)   # E9
    d = {r.client_id: r for r in marts.dim_clients(stg).collect()}
    assert d[1].full_name == "Ana" and d[2].full_name == "Unknown Name" and d[3].full_name == "Unknown Name"
    assert [d[i].risk_category for i in (1, 2, 3, 4, 5)] == \
        ["High Risk", "Medium Risk", "Medium Risk", "Low Risk", "Unrated"]        # E8
    assert d[-1].full_name == "Unknown Client" and d[-1].registered_at is None


def test_countries_location(spark):
    schema = S.RAW_SCHEMAS["countries"]
    rows = [(7, "AE", "UAE", "aed", None), (5, "EG", " egypt ", "egp", None), (9, "X", None, None, None),
            (4, "A", "b", "x", None), (4, "A", "a", "x", None), (4, "A", None, "x", None)]
    loc = {r.country_id: r for r in marts.dim_location(staging.stg_countries(
        spark.createDataFrame(rows, schema))).collect()}
    assert (loc[7].country_name, loc[7].local_currency, loc[7].region) == ("Uae", "AED", "Other")   # D1
    assert loc[7].location_key == "aad1f6728422059adc904e0ee0e7ff7c"
    assert (loc[5].country_name, loc[5].region) == ("Egypt", "Middle East")
    assert loc[5].location_key == "b60f6296cdb14f8caf30cd67ddc8ddcc"
    assert (loc[9].country_name, loc[9].local_currency, loc[9].region) == (None, "UNKNOWN", "Other")
    assert loc[9].location_key == "94d0275568240bdef85a32a7bbb2a3cf"
    assert loc[4].country_name == "A"                                                               # E14
    assert loc[-1].location_key == "unknown"


def test_merchants(spark):
    schema = S.RAW_SCHEMAS["merchants"]
    base = {f.name: None for f in schema.fields}
    rows = [base | dict(merchant_id=1, trade_name="o'brien-smith LLC", mcc=5411),
            base | dict(merchant_id=2, trade_name=None, mcc=5812),
            base | dict(merchant_id=3, trade_name="a", mcc=5912), base | dict(merchant_id=3, trade_name="a", mcc=5541),
            base | dict(merchant_id=4, trade_name="b", mcc=None)]
    d = marts.dim_merchants(spark.createDataFrame(rows, schema)).collect()
    by = {}
    for r in d:
        by.setdefault(r.merchant_id, []).append(r)
    assert by[1][0].merchant_name == "O'Brien-Smith Llc"                          # E15
    assert by[2][0].merchant_name == "Unknown Merchant"
    assert len(by[3]) == 2                                                         # E17 (D3 kept)
    assert sorted(r.merchant_category_group for r in by[3]) == ["OTHER", "PHARMACY"]
    assert by[4][0].merchant_category_group == "OTHER" and by[-1][0].merchant_name == "Unknown Merchant"


def test_dim_date(spark):
    d = {r.date_key: r for r in marts.dim_date().collect()}
    assert len(d) == 730                                                           # E20
    r = d[dt.date(2025, 5, 1)]
    assert (r.month_name, r.day_name, r.day_type, r.quarter) == ("May      ", "Thursday ", "Weekday", "Q2")
    assert [d[dt.date(2025, 1, x)].day_type for x in (3, 4, 5)] == ["Weekend", "Weekend", "Weekday"]


def test_daily_mean_rounds_half_up(spark):
    fact = spark.createDataFrame(
        [(1, 1, 1, Decimal("1.00"), "USD", TS(2025, 1, 1), dt.date(2025, 1, 1)),
         (2, 1, 1, Decimal("1.01"), "USD", TS(2025, 1, 1), dt.date(2025, 1, 1))],
        "transaction_id bigint, client_id bigint, merchant_id bigint, amount decimal(14,2), currency string, "
        "initiated_at_timestamp timestamp_ntz, date_key date")
    r = marts.fct_daily_merchant_sales(fact).collect()[0]
    assert (r.total_transaction_count, r.daily_total_amount, r.avg_transaction_value) == \
        (2, Decimal("2.01"), Decimal("1.01"))                                      # E21


def test_unknown_member_join(spark):
    from paylake.operators.staging import stg_clients
    raw = _txn(spark, [(4, None, None, Decimal("-12.50"), None, TS(2025, 3, 1), TS(2025, 3, 1))])
    fact = marts.fact_transactions(staging.stg_clean_transactions(staging.stg_transactions(raw)))
    schema = S.RAW_SCHEMAS["clients"]
    dims = marts.dim_clients(stg_clients(spark.createDataFrame([], schema)))
    j = fact.join(dims, "client_id", "left").collect()
    assert j[0].full_name == "Unknown Client"                                      # E22
