"""Benchmark: run the headline queries at $BENCH_SF_DIR and print one JSON line.

Each query is fully materialised with a no-op sink (``write.format("noop")``)
so Spark runs the whole plan without collecting rows to the driver. A first
pass warms the JVM; the reported time per query is the warm run.
"""
from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "fct_daily_merchant_sales", "star_sales", "stg_transactions", "dim_clients",
    "dq_report", "fraud_velocity_burst", "fraud_card_testing", "fraud_international_spree",
    "fraud_account_takeover", "settlement_batches", "refund_net", "approved_sales",
    "fk_orphans", "dead_letter", "landing_stream",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from paylake.session import build_session
    from paylake.plans.catalog import QUERIES
    spark = build_session(f"local[{cpus}]", shuffle_partitions=int(cpus) * 2)
    keys = [k for k in HEADLINE if k in QUERIES]
    if os.environ.get("BENCH_ALL"):
        keys = list(QUERIES)
    cold, warm = {}, {}
    for k in keys:
        t0 = time.time()
        QUERIES[k](spark, sf_dir).write.format("noop").mode("overwrite").save()
        cold[k] = round(time.time() - t0, 3)
    for k in keys:
        t0 = time.time()
        QUERIES[k](spark, sf_dir).write.format("noop").mode("overwrite").save()
        warm[k] = round(time.time() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total_warm", "value": round(sum(warm.values()), 3),
                      "unit": "sec", "queries": warm, "cold": cold, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
