"""Every registered query against its DuckDB oracle (sf0.001)."""
import pytest

from paylake.plans.catalog import ORACLES, QUERIES
from paylake.tools.oracle_check import compare

from conftest import SF_SMALL


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_matches_oracle(spark, duck_small, key):
    r = compare(QUERIES[key](spark, SF_SMALL), ORACLES[key], duck_small)
    assert r["schema_match"], r
    assert r["match"], r


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("key", ["fraud_velocity_burst", "fraud_card_testing", "fraud_international_spree",
                                 "fraud_high_value", "fraud_night_owl", "fraud_account_takeover",
                                 "dead_letter", "dq_unique", "refund_net"])
def test_detectors_not_empty(spark, key):
    # a comparison must never pass on emptiness
    assert QUERIES[key](spark, SF_SMALL).count() > 0


def test_every_reject_reason_occurs(spark):
    got = {r.error_msg for r in QUERIES["dead_letter"](spark, SF_SMALL).select("error_msg").distinct().collect()}
    assert got == {"malformed_json", "not_an_object", "null_payload", "no_known_field", "type_mismatch:txn_id"}


def test_fk_orphans_are_found(spark):
    got = {(r.child_table, r.child_column): r.orphans for r in QUERIES["fk_orphans"](spark, SF_SMALL).collect()}
    assert got[("transactions", "pos_id")] > 0        # merchant-country orphans start at sf0.01
    assert got[("transactions", "type_id")] == 0
