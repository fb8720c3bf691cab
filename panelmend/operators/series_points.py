"""Points of many series in long form, and putting repaired points back.

Detection stays in the wide panel. Only what a repair needs is turned to long form, so the work
grows with the number of affected series and flagged points rather than with the panel.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelmend.layout import Layout


def to_points(df: DataFrame, columns: list[str], fields: dict, keep=("ticker", "seq"),
              where=None) -> DataFrame:
    """One row per column of each panel row: ``fields[name](column)`` gives each value.

    ``where`` drops points before they are spread over rows.
    """
    points = F.array(*[F.struct(F.lit(c).alias("column"), *[
        fn(c).alias(n) for n, fn in fields.items()]) for c in columns])
    if where is not None:
        points = F.filter(points, where)
    return df.select(*keep, F.explode(points).alias("_p")).select(*keep, "_p.*")


def series_of(df: DataFrame, series: DataFrame) -> DataFrame:
    """All rows (ticker, column, seq, v) of the listed series; others are never spread out."""
    numeric = [f.name for f in df.schema.fields
               if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    # a ticker's list is at most as long as the panel is wide
    listed = series.groupBy("ticker").agg(F.collect_set("column").alias("_cols"))
    values = F.create_map(*[x for c in numeric for x in (F.lit(c), F.col(c).cast("double"))])
    return (df.join(listed, "ticker")
            .select("ticker", "seq", F.explode("_cols").alias("column"), values.alias("_v"))
            .select("ticker", "column", "seq", F.try_element_at("_v", F.col("column")).alias("v")))


def flagged_points(df: DataFrame, columns: list[str], flags: dict[str, Column],
                   scores: dict[str, Column], limits: dict[str, Column],
                   extra: dict | None = None) -> DataFrame:
    """Outliers in long form: ticker, seq, column, value, score, limit and extra statistics."""
    fields = {"v": F.col, "score": lambda c: scores[c], "limit": lambda c: limits[c],
              "hit": lambda c: F.coalesce(flags[c], F.lit(False)) & F.col(c).isNotNull()}
    for name, by_column in (extra or {}).items():
        fields[name] = lambda c, m=by_column: m[c]
    return to_points(df, columns, fields, where=lambda p: p["hit"]).drop("hit")


def apply_repairs(df: DataFrame, repairs: DataFrame, columns: list[str],
                  layout: Layout | None = None) -> DataFrame:
    """Overwrite panel values by (ticker, seq, column, corrected).

    A panel row gets one small map, with at most one entry per column, so joining is on the
    evenly spread key (ticker, seq). Where ``layout`` has no long tickers, repairs are dealt by ticker: a
    panel that lies so is joined as it lies.
    """
    if layout is not None and not layout.blocked:
        repairs = repairs.repartition("ticker")
    fixes = repairs.where(F.col("corrected").isNotNull()).groupBy("ticker", "seq").agg(
        F.map_from_entries(F.collect_list(F.struct("column", "corrected"))).alias("_fix"))
    joined = df.join(fixes, ["ticker", "seq"], "left")
    return joined.withColumns({
        c: F.coalesce(F.try_element_at("_fix", F.lit(c)), F.col(c)) for c in columns
    }).drop("_fix")
