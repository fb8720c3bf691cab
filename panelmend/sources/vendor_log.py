"""Free-text vendor error logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MARK = "[ERROR]"
# fixed values: one record after its mark, and the categories its message falls into
RECORD = r"(?s)^\s*(?:\[ERROR\])?\s*(\S+)\s+skipping output.*?:\s*(.+)$"
CATEGORIES = [
    (["not correctly sorted by date"], "FundamentalData rows not sorted by date"),
    (["Negative", "shares_outstanding"], "Negative shares outstanding"),
    (["No data returned by unadjusted market data endpoint"], "No unadjusted market data"),
    (["low > high"], "Market data low > high"),
    (["Negative", "low"], "Negative price value"),
]


def read_vendor_log(spark: SparkSession, path: str) -> DataFrame:
    """One record per error mark, however many lines it spans; the file splits anywhere."""
    return spark.read.option("lineSep", MARK).text(path).withColumnRenamed("value", "record")


def parse_vendor_log(records: DataFrame, column: str = "record") -> DataFrame:
    """Add ticker, message (whitespace collapsed) and category; other text is dropped."""
    out = records.withColumn("ticker", F.regexp_extract(column, RECORD, 1)).withColumn(
        "message", F.trim(F.regexp_replace(F.regexp_extract(column, RECORD, 2), r"\s+", " ")))
    category = None
    for words, name in CATEGORIES:
        hit = F.lit(True)
        for word in words:
            hit = hit & F.col("message").contains(word)
        category = F.when(hit, name) if category is None else category.when(hit, name)
    return out.withColumn("category", category.otherwise(F.col("message"))).where(
        (F.col("ticker") != "") & (F.col("message") != ""))


def summarise_vendor_log(parsed: DataFrame) -> DataFrame:
    """Tickers per category with how often each occurs, largest category first.

    One row per category and ticker rather than one list per category: a category may hold
    most of the log.
    """
    per = parsed.groupBy("category", "ticker").agg(F.count(F.lit(1)).alias("entries"))
    total = parsed.groupBy("category").agg(F.count(F.lit(1)).alias("category_count"))
    return per.join(total, "category").select(
        "category", "category_count", "ticker", "entries").orderBy(
        F.col("category_count").desc(), "category", "ticker")
