"""paylake: payment-gateway analytics on Spark.

Raw operational tables (transactions, clients, merchants, ...) are cleaned,
deduplicated and reshaped into a star schema, gated by data-quality checks,
and queried for fraud patterns, refunds and settlements -- in batch and with
Structured Streaming. Every operator is a DataFrame expression so Catalyst
and AQE plan it; no Python UDF sits on a data path.
"""

__version__ = "0.1.0"
