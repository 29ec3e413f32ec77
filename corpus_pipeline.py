"""Training-corpus pipeline: quality rules, near-duplicates, secrets, mixing, encoding.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written and
reread as the next stage's ``docs``; all but the last keep the columns of documents.

In every stage a null text counts as empty (and stays null where the text is kept), a null
doc_id is a row like any other, repeated rows are treated one by one except where one row of
a group stays, an empty table gives an empty result, and other columns pass through.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from paylake.llm import bpe_trie, curriculum, quality, secrets_crf, simhash
from paylake.llm.common import documents, settle


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass every quality rule."""
    return quality.keep_good(docs)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest doc_id, of every group of near-duplicates."""
    return simhash.keep_first(docs, size=3, max_bits=3)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its secrets replaced by a mark (n_chars follows the new text)."""
    return secrets_crf.redact(docs, secrets_crf.train(docs))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The copies that the source mix takes, in training order."""
    return curriculum.mix(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, with the digests of ids and decoded text."""
    return bpe_trie.encode(docs)


STAGES = [
    ("quality_rules", good_quality),
    ("simhash_near_dedup", one_of_each),
    ("secret_scan", without_secrets),
    ("source_mix", mixed),
    ("bpe_encode", encoded),
]

# the secret field, the fingerprints and the encoder have no SQL form; the stages are tested by brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
