"""Registered queries of the training-data operators, with SQL texts where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (
    chunk_dedup, decontamination, licenses, line_dedup, mixing, near_dedup, phrases, quality_rules, secret_scan, sharding, spelling,
    sql_texts, suffix_dedup, url_filter,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(_table(spark, sf_dir, "documents"))


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.groups(_table(spark, sf_dir, "documents"), width=3, percent=85)


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(_table(spark, sf_dir, "documents"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents")).drop("source")


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(_table(spark, sf_dir, "documents").select("doc_id", "source", "text")).select(
        "doc_id", "source", F.octet_length("text").cast("long").alias("n_bytes"), "slot", "shard"
    )


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2("base_spans", 256).alias("base_sha256"), "spans"
    )


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def op9_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = chunk_dedup.remove_chunks(_table(spark, sf_dir, "documents"))
    return out.withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"), "contaminated"
    )


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(_table(spark, sf_dir, "documents"))


def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(_table(spark, sf_dir, "pages"))


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.mine(_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_near_dedup": op2_near_dedup,
    "op3_quality_rules": op3_quality_rules,
    "op4_mixing": op4_mixing,
    "op5_sharding": op5_sharding,
    "op6_secrets": op6_secrets,
    "op7_decontamination": op7_decontamination,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_chunk_dedup": op9_chunk_dedup,
    "op10_licenses": op10_licenses,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_url_filter": op12_url_filter,
    "op13_phrases": op13_phrases,
}
ORACLES: dict[str, str] = dict(sql_texts.ORACLES)
