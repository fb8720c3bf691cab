"""One query per operator, over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelmend.llm import (
    collocations, forest, jaccard, lloyd, mixing, neighbours, packing, quality, secrets, suffixes,
    surrogates, token_counts, warc,
)
from panelmend.llm.common import Scratch, table


def op1_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surrogates.replaced(spark.read.parquet(table(sf_dir, "documents")))


def op2_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest vectors of every hundredth vector."""
    rows = spark.read.parquet(table(sf_dir, "embeddings"))
    vectors = rows.where(neighbours.usable(F.col("embedding")) & F.col("vec_id").isNotNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("vector"))
    index = Scratch(spark).table(neighbours.index(vectors), "index")
    queries = vectors.where("vec_id % 100 = 0").withColumnRenamed("vec_id", "query_id")
    return neighbours.search(queries, index)


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(spark.read.parquet(table(sf_dir, "documents")))


def op4_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar(spark.read.parquet(table(sf_dir, "documents")), n=4, percent=85)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(spark.read.parquet(table(sf_dir, "documents")),
                            spark.read.parquet(table(sf_dir, "labels")))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(spark.read.parquet(table(sf_dir, "documents")))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(spark.read.parquet(table(sf_dir, "documents")))


def op8_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.near_duplicates(spark.read.parquet(table(sf_dir, "embeddings")))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(spark.read.parquet(table(sf_dir, "documents")))


def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.without_repeats(spark.read.parquet(table(sf_dir, "documents")))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lloyd.codes(spark.read.parquet(table(sf_dir, "embeddings")))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(spark.read.parquet(table(sf_dir, "documents")))


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.digest(spark.read.parquet(table(sf_dir, "pages")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_surrogates, op2_neighbours, op3_secrets, op4_jaccard, op5_quality,
                            op6_packing, op7_token_counts, op8_near_vectors, op9_mixing,
                            op10_repeats, op11_vector_codes, op12_collocations, op13_warc)}
ORACLES: dict[str, str] = {"op9_mixing": mixing.ORACLE, "op11_vector_codes": lloyd.oracle(),
                           "op12_collocations": collocations.ORACLE, "op13_warc": warc.ORACLE}
