"""The registered queries of the subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gasledger.llm import (
    bpe_prefix,
    decontaminate,
    filter_audit,
    line_dedup,
    merkle,
    near_dedup,
    packing,
    quality_model,
    quality_rules,
    sql,
    substring_dedup,
    suffix_dedup,
    tokens,
    toxicity,
)
from gasledger.llm.common import table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted", "evidence")


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_components(table(spark, sf_dir, "documents"), k=3, percent=85)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "line_dedup.*", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("item_ids"), ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.repeated_passages(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.col("n_units").alias("n_words"), "n_removed", "kept_sha256")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept")


def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.repeated_bytes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.col("n_units").alias("n_bytes"), "n_removed",
                        F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(table(spark, sf_dir, "documents"), tokens.default_path())


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokens.default_path())


def op11_filter_interaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bpe_prefix.round_trip(table(spark, sf_dir, "documents"), tokens.default_path())
    return found.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2("text", 256).alias("decoded_sha256"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = merkle.manifest(table(spark, sf_dir, "documents"), merkle.without_newlines())
    return merkle.verified(rows).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_toxicity, op2_quality_classifier, op3_minhash_near_dedup, op4_line_dedup, op5_decontamination, op6_substring_dedup,
        op7_quality_rules, op8_suffix_array_dedup, op9_token_counts, op10_packing,
        op11_filter_interaction, op12_bpe_round_trip, op13_merkle_manifest)}


def oracle_sql() -> dict[str, str]:
    return {"op3_minhash_near_dedup": sql.NEAR_DEDUP, "op4_line_dedup": sql.LINE_DEDUP,
            "op5_decontamination": sql.DECONTAMINATION, "op7_quality_rules": sql.QUALITY_RULES,
            "op11_filter_interaction": sql.FILTER_INTERACTION, "op13_merkle_manifest": sql.MERKLE_MANIFEST}
