"""Option builders for the production sources and sinks.

The image carries no JDBC driver, Kafka or object-store connector jars, so
these return plain option dictionaries (unit-tested as such); the batch and
streaming code accepts any DataFrame, so swapping the test file sources for
these readers needs no other change.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_table_options(url: str, table: str, key: str, lower: int, upper: int, partitions: int,
                       user: str | None = None, password: str | None = None,
                       fetch_size: int = 10_000) -> dict[str, str]:
    """Parallel full extract of one operational table (S1): ``partitions``
    key ranges read concurrently instead of LIMIT/OFFSET pages."""
    opts = {"url": url, "dbtable": table, "partitionColumn": key, "lowerBound": str(lower),
            "upperBound": str(upper), "numPartitions": str(partitions), "fetchsize": str(fetch_size)}
    if user:
        opts["user"] = user
    if password:
        opts["password"] = password
    return opts


def jdbc_incremental_query(table: str, watermark_col: str, since: str, inclusive: bool = True) -> str:
    """Sub-query for an incremental extract (S3); ``>=`` by default."""
    op = ">=" if inclusive else ">"
    return f"(SELECT * FROM {table} WHERE {watermark_col} {op} '{since}') AS delta"


def jdbc_write_options(url: str, table: str, batch_size: int = 1000) -> dict[str, str]:
    """Warehouse append (K5) in batches of ``batch_size`` rows."""
    return {"url": url, "dbtable": table, "batchsize": str(batch_size)}


def kafka_source_options(brokers: str, topic_pattern: str = r"pg\.(?!__).*",
                         max_offsets_per_trigger: int | None = None, starting: str = "earliest") -> dict[str, str]:
    """Subscribe to every data topic by pattern from the earliest offset
    (S6, S7); internal ``pg.__*`` topics are excluded (D11). No cap on a
    trigger's size unless one is given; lost offsets fail the query."""
    opts = {"kafka.bootstrap.servers": brokers, "subscribePattern": topic_pattern,
            "startingOffsets": starting, "failOnDataLoss": "true"}
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return opts


def kafka_sink_options(brokers: str) -> dict[str, str]:
    """Publishing change messages (K1): rows carry ``topic``, ``key``, ``value``."""
    return {"kafka.bootstrap.servers": brokers}


def object_store_conf(endpoint: str, access_key: str, secret_key: str, path_style: bool = True) -> dict[str, str]:
    """Hadoop S3A settings for the raw-zone bucket."""
    return {"spark.hadoop.fs.s3a.endpoint": endpoint, "spark.hadoop.fs.s3a.access.key": access_key,
            "spark.hadoop.fs.s3a.secret.key": secret_key,
            "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower()}


def read_kafka_messages(spark: SparkSession, opts: dict[str, str]) -> DataFrame:
    """Kafka stream in the message shape of :mod:`paylake.streaming.landing`."""
    raw = spark.readStream.format("kafka").options(**opts).load()
    return raw.selectExpr("topic", "CAST(key AS STRING) AS message_key", "CAST(value AS STRING) AS value")


def kafka_records(messages: DataFrame) -> DataFrame:
    """Change messages as the Kafka sink takes them: ``topic``, ``key``, ``value`` (K1)."""
    return messages.selectExpr("topic", "CAST(message_key AS STRING) AS key", "CAST(value AS STRING) AS value")


def write_kafka_messages(messages: DataFrame, opts: dict[str, str]) -> None:
    """Publish change messages; the broker partitions them by key, so versions of one row stay in order."""
    kafka_records(messages).write.format("kafka").options(**opts).save()


def jdbc_range_reads(spark: SparkSession, url: str, table: str, predicates: list[str], properties: dict[str, str]) -> DataFrame:
    """Full extract of a table in the key ranges of :func:`extract.range_predicates` (S1): one
    concurrent query per range, of even size whatever the gaps of the key."""
    return spark.read.jdbc(url, table, predicates=predicates, properties=properties)
