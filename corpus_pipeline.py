"""A corpus pipeline of five stages: toxic documents go, then copies, then near copies; secrets are masked; the rest is packed.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from linkloom.llm import exact_dedup, packing, secret_scan, simhash, toxicity
from linkloom.llm.common import discard, documents, labels, materialize


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score toxicity.THRESHOLD or more go; the model is fitted on docs and the labels it may see. Null texts count as empty and stay."""
    return toxicity.drop_toxic(docs, toxicity.fit(docs, toxicity.training_labels(labels(spark, sf_dir))))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for white space the row with the smallest doc_id stays; null counts as empty, repeated rows go."""
    return exact_dedup.drop_exact_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Five-word shingles, similarity 0.8 or more; the smallest doc_id of each group stays, as do rows without an id or without words."""
    return simhash.drop_near_duplicates(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; what the forest takes for a secret is masked in its text."""
    return secret_scan.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row as pieces in batches; a null or empty text is one piece without tokens, and no rows give none."""
    return packing.packed(docs)


STAGES = [("toxicity", drop_toxic), ("exact_dedup", drop_copies), ("simhash_near_dedup", drop_near_copies), ("secret_scan", mask_secrets), ("packing", pack)]

#: Learned models and an optimisation decide, which SQL can't express; tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order; what a stage leaves is written, read by the next one, and deleted once that one's rows are written too."""
    docs = documents(spark, sf_dir)
    for k, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            out = materialize(out)
            if k:
                discard(docs)
        docs = out
    return docs
