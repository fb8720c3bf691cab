"""From raw documents to packed sequences: classify, de-duplicate, mask secrets, mix, pack."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelmend.llm import jaccard, mixing, packing, quality, secrets
from panelmend.llm.common import Scratch, table
from panelmend.workspace import shuffles_deleted


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what the classifier, learned from ``labels``, rejects."""
    model = quality.train(docs, spark.read.parquet(table(sf_dir, "labels")))
    return docs.where(quality.score_column(model, F.col("text")) >= 0.5)


def keep_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of near duplicates (five words, 0.8)."""
    return jaccard.one_of_each(docs, n=5, percent=80)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.repeated(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("quality classifier", keep_quality),
    ("n-gram Jaccard join", keep_distinct),
    ("secret scans", mask_secrets),
    ("mixing sources to target weights", mix_sources),
    ("packing", pack_sequences),
]

#: A learned classifier, a tokenizer and nested decoding are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each reads what its predecessor wrote, which is then deleted."""
    scratch = Scratch(spark)
    docs, before = spark.read.parquet(table(sf_dir, "documents")), None
    for name, stage in STAGES[:-1]:
        with shuffles_deleted(spark):
            docs, path = scratch.save(stage(spark, docs, sf_dir), name.split()[0])
        if before:  # read for the last time
            scratch.drop(before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
