"""Registered queries of the text operators: ``QUERIES[key](spark, sf_dir)``.

Every query reads whole tables and derives the digest columns of its contract
from the operator's real output.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from paylake.llm import sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(key: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[key] = fn
        if oracle is not None:
            ORACLES[key] = oracle
        return fn
    return deco


@query("op7_quality_rules", sql.QUALITY)
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from paylake.llm.common import documents
    from paylake.llm.quality import measure
    m = measure(documents(spark, sf_dir))
    return m.select("_row.doc_id", *[f"_q.{c}" for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")])


@query("op2_bpe_trie")
def op2_bpe_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from paylake.llm.bpe_trie import encode
    from paylake.llm.common import documents
    return encode(documents(spark, sf_dir), ids=False)


@query("op3_secret_scan")
def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from paylake.llm.common import documents
    from paylake.llm.secrets_crf import scan, train
    docs = documents(spark, sf_dir)
    return scan(docs, train(docs))


@query("op4_curriculum_mix", sql.MIX)
def op4_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from paylake.llm.common import documents
    from paylake.llm.curriculum import report
    return report(documents(spark, sf_dir)).select(
        "doc_id", "size", "source_size", "target", "taken", "copies", "first_time")


@query("op5_simhash_anchors")
def op5_simhash_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    from paylake.llm.common import documents
    from paylake.llm.simhash import near_duplicates
    return near_duplicates(documents(spark, sf_dir), size=3, max_bits=3)


@query("op8_toxic_segments")
def op8_toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    from paylake.llm.common import documents
    from paylake.llm.toxicity import score, train
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return score(docs, train(docs, labels))


@query("op6_relative_lz", sql.REPEATS)
def op6_relative_lz(spark: SparkSession, sf_dir: str) -> DataFrame:
    from paylake.llm.common import documents
    from paylake.llm.relative_lz import remove_repeats
    return remove_repeats(documents(spark, sf_dir), window=35)


@query("op1_context_tree")
def op1_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    from paylake.llm.common import documents
    from paylake.llm.context_tree import score
    return score(documents(spark, sf_dir))


@query("op10_lookup_sketch")
def op10_lookup_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    from paylake.llm.common import documents
    from paylake.llm.iblt import compare_edited
    return compare_edited(documents(spark, sf_dir))


@query("op9_license_windows", sql.LICENSES)
def op9_license_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    from paylake.llm.common import documents
    from paylake.llm.licenses import SHORT_TEMPLATES, TEMPLATES, scan
    return scan(documents(spark, sf_dir), (*TEMPLATES, *SHORT_TEMPLATES))


# the notices of less than five words alone
@query("op9_license_short")
def op9_license_short(spark: SparkSession, sf_dir: str) -> DataFrame:
    from paylake.llm.common import documents
    from paylake.llm.licenses import SHORT_TEMPLATES, scan
    return scan(documents(spark, sf_dir), SHORT_TEMPLATES)


@query("op11_source_divergence", sql.DIVERGENCE)
def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    from paylake.llm.common import documents
    from paylake.llm.divergence import audit
    return audit(documents(spark, sf_dir))


@query("op12_piece_agenda")
def op12_piece_agenda(spark: SparkSession, sf_dir: str) -> DataFrame:
    from paylake.llm.common import documents
    from paylake.llm.piece_agenda import encode
    return encode(documents(spark, sf_dir), ids=False)


@query("op13_periodic_runs", sql.RUNS)
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from paylake.llm.common import documents
    from paylake.llm.periodic_runs import digest, find_runs, with_planted
    docs = documents(spark, sf_dir).select("doc_id", with_planted(F.col("doc_id"), F.col("text")).alias("text"))
    return digest(find_runs(docs))
