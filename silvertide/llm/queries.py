"""The registered queries of this package: each operator over its whole table, with production parameters."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silvertide.llm import (
    decontaminate, host_reputation, importance, line_crf, lsh_forest, mixing, pii, prefix_trie, quality_rules, simhash,
    slots, toxicity, warc,
)

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.fingerprint_text(F.col("fp")).alias("fingerprint"), "component_id")


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = pii.find_spans(_table(spark, sf_dir, "documents"))
    everything = F.array_sort(F.concat("base", "added"))

    def count(k: int) -> Column:  # a second parameter of the lambda would be the place of the span
        return F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")

    # As the digest, the counts are of base spans; what the method adds is in spans.
    counts = [count(k).alias(f"n_{kind}") for k, kind in enumerate(pii.KINDS)]
    return spans.select("doc_id", "base", everything.alias("spans")).select(
        "doc_id", *counts, F.sha2(pii.span_text(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        pii.span_text(F.col("spans")).alias("spans"),
    )


def op3_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_reputation.judge(_table(spark, sf_dir, "pages"), _table(spark, sf_dir, "labels"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(_table(spark, sf_dir, "documents")).drop("mark")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = toxicity.toxicity_report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    told = F.transform("evidence", lambda e: F.concat_ws(":", e["doc_id"], F.format_string("%.4f", e["similarity"]), e["toxic"].cast("string")))
    return report.withColumn("evidence", F.array_join(told, ","))


def op7_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    maps = slots.map_folder(spark, f"documents-{hashlib.sha256(sf_dir.encode()).hexdigest()[:16]}")
    return slots.shard_documents(_table(spark, sf_dir, "documents"), maps=maps)


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_table(spark, sf_dir, "pages")).drop("url")


def op9_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_crf.quality_report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")).drop("n_lines", "n_bad_lines")


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination_report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op11_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lsh_forest.near_duplicate_report(_table(spark, sf_dir, "documents"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(_table(spark, sf_dir, "conversations"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.importance_report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")).drop("mark")


def all_queries() -> dict[str, Query]:
    named = (
        op1_simhash, op2_pii, op3_host_reputation, op4_mixing, op5_quality_rules, op6_toxicity, op7_virtual_slots, op8_warc,
        op9_line_crf, op10_decontaminate, op11_lsh_forest, op12_prefix_trie, op13_importance_resampling,
    )
    return {f.__name__: f for f in named}
