"""The opN queries: each applies its operator with production parameters to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, exact_dedup, license_scan, packing, pii, quality_rules, secret_scan, simhash, suffix_dedup, toxicity
from .common import documents, labels
from .sql import ORACLES


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted. The fit sees only labels whose id passes training_labels()."""
    docs = documents(spark, sf_dir)
    scored = toxicity.toxicity_scores(docs, toxicity.fit(docs, toxicity.training_labels(labels(spark, sf_dir))))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(documents(spark, sf_dir))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_scan(documents(spark, sf_dir))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.digests(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_findings(documents(spark, sf_dir))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_spans(documents(spark, sf_dir))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(documents(spark, sf_dir))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_bytes(documents(spark, sf_dir))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_flags(documents(spark, sf_dir)).drop("lost_percent", "cleaned")


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(documents(spark, sf_dir))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_toxicity, op2_packing, op3_license_scan, op4_byte_bpe, op5_secret_scan, op6_pii, op7_simhash, op8_suffix_dedup, op9_quality_rules, op10_exact_dedup)}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
