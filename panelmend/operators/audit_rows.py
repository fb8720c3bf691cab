"""Building rows of the audit trail."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelmend.schema import AUDIT, RULES


def audit_rows(df: DataFrame, rule: str, fields: Mapping[str, Column],
               payload: Mapping[str, Column] | None = None) -> DataFrame:
    """Project ``df`` to audit rows of one rule; fields not given are null."""
    stage, category = RULES[rule]
    given = {"stage": F.lit(stage), "rule": F.lit(rule), "category": F.lit(category),
             "ticker": F.col("ticker"), "filter_type": F.lit("correction"), **fields}
    if payload:
        entries = []
        for name, value in payload.items():
            entries += [F.lit(name), value.cast("string")]
        given["payload"] = F.create_map(*entries)
    return df.select(*[
        given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in AUDIT.fields])


def no_rows(df: DataFrame, rule: str) -> DataFrame:
    """An empty audit, for panels that lack a rule's columns."""
    return audit_rows(df.where(F.lit(False)), rule, {})


def first_per(df: DataFrame, keys: list[str], order: list[Column], n: int | None = None) -> DataFrame:
    """Keep the first ``n`` rows per key; all rows unless a limit is asked for.

    The row-number filter lets Spark cut each task's rows to ``n`` per key before the
    shuffle, so a key with very many rows costs no more than any other.
    """
    if n is None:
        return df
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")
