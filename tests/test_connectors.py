from paylake.sources import connectors as C


def test_jdbc_options_are_parallel_key_ranges():
    o = C.jdbc_table_options("jdbc:mysql://db/pay", "transactions", "txn_id", 1, 1_000_000, 64)
    assert o["partitionColumn"] == "txn_id" and o["numPartitions"] == "64" and o["upperBound"] == "1000000"
    assert ">=" in C.jdbc_incremental_query("transactions", "created_at", "2026-01-01 00:00:00")


def test_kafka_options_exclude_internal_topics():
    import re
    o = C.kafka_source_options("broker:9092")
    pat = re.compile(o["subscribePattern"])
    assert pat.fullmatch("pg.transactions") and not pat.fullmatch("pg.__producer_state")
    assert o["startingOffsets"] == "earliest"


def test_tune_for_input(spark):
    from paylake.session import tune_for_input
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert tune_for_input(spark, 100 * 1024 ** 4) > 400_000
        assert tune_for_input(spark, 10 * 1024 ** 2) == 200
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.initialPartitionNum")
