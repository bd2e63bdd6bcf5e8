"""From raw documents to packed sequences: the stages of a training corpus.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame; run() writes each as Parquet and
reads it again as the next one's documents. All stages but the last return the columns of the
documents. A stage decides over all rows that its predecessor kept.

Nulls: a null text is an empty one, a null doc_id an id like another. Empty tables pass.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from clickwell.llm import common, exact_dedup, near_dedup, packing, secrets, toxicity


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the threshold stay. The model learns from the labels of `docs`."""
    labels = common.table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels, ~toxicity.held_out(F.col("doc_id")))
    score = toxicity.score(F.coalesce(docs["text"], F.lit("")), model, spark)
    scored = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"), score.alias("score"))
    return scored.where(F.col("score") < toxicity.THRESHOLD).select("doc.*")


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each text stays: the one with the largest doc_id."""
    common.ready(spark)
    decided = exact_dedup.dedup(docs, exact_dedup.earlier_half(docs))
    return common.keep_ids(docs, decided.select("doc_id", "text_sha256", "kept"))


def drop_near_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates stays: the one with the largest doc_id."""
    common.ready(spark)
    return common.keep_ids(docs, near_dedup.group(docs).select("doc_id", "text_sha256", "kept"))


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; credentials that look live are replaced in their texts."""
    common.ready(spark)
    return secrets.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences, with a checksum in place of their ids."""
    common.ready(spark)
    return packing.digests(packing.pack(docs, packing.default_path()))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_repeats),
    ("near_dedup", drop_near_repeats),
    ("secrets", hide_secrets),
    ("packing", pack),
]

# SQL knows neither the learned model nor the signatures; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
