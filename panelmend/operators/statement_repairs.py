"""Forward-fill repairs of statement columns: negatives, zero shares, tenfold jumps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelmend import schema as S
from panelmend.functions.dates import quarter_label
from panelmend.layout import Layout
from panelmend.operators.audit_rows import audit_rows, first_per, no_rows


def by_quarter(df: DataFrame, keys: list[str], aggs: dict[str, Column],
               date: str = "m_date", n: int | None = None) -> DataFrame:
    """Summarise flagged rows per ticker and quarter; ``n`` keeps each key's earliest quarters."""
    out = (df.withColumn("quarter", quarter_label(date))
           .groupBy("ticker", *keys, "quarter")
           .agg(F.min(date).alias("date_start"), F.max(date).alias("date_end"),
                F.count(F.lit(1)).alias("count"), *[e.alias(n) for n, e in aggs.items()]))
    return first_per(out, ["ticker", *keys],
                     [F.col("date_start").asc_nulls_first(), F.col("quarter")], n)


QUARTER_FIELDS = ("date_start", "date_end", "quarter", "count")


def quarter_fields() -> dict[str, Column]:
    return {c: F.col(c) for c in QUARTER_FIELDS}


# -- negative statement values ----------------------------------------------------------------
def fill_negative_statements(df: DataFrame, layout: Layout,
                             columns=S.NONNEGATIVE_STATEMENT) -> DataFrame:
    """Replace negative or missing values by the ticker's last non-negative one."""
    cols = S.present(df, columns)
    return layout.last_valid(df, {c: F.when(F.col(c) >= 0, F.col(c)) for c in cols})


def negative_statement_audit(df: DataFrame, columns=S.NONNEGATIVE_STATEMENT,
                             date: str = "m_date") -> DataFrame:
    """Per column and quarter: span, first negative value and number of negative rows."""
    cols = S.present(df, columns)
    if not cols:
        return no_rows(df, "negative_fundamentals_logs")
    entries = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("v")) for c in cols])
    bad = (df.select("ticker", "seq", date, F.explode(F.filter(entries, lambda e: e["v"] < 0))
                     .alias("e")).select("ticker", "seq", date, "e.*"))
    rows = by_quarter(bad, ["column"], {"value": F.min_by("v", "seq")}, date)
    return audit_rows(rows, "negative_fundamentals_logs", {
        **quarter_fields(),
        "error_type": F.lit("negative_value"),
        "column": F.col("column"),
        "original_value": F.col("value"),
        "method": F.lit("forward_fill"),
        "message": F.concat(F.lit("Negative value "), F.col("value").cast("string"),
                            F.lit(" in "), F.col("column")),
    })


# -- zero shares while trading ------------------------------------------------------------------
def _zero_while_trading(c: str) -> Column:
    return (F.col(c) == 0) & (F.col("m_volume") > 0)


def fill_zero_shares(df: DataFrame, layout: Layout, columns=S.ZERO_WIPEOUT) -> DataFrame:
    """Zero share counts on days with volume become the last known count."""
    cols = S.present(df, columns) if "m_volume" in df.columns else []
    return layout.last_valid(df, {
        c: F.when(_zero_while_trading(c), F.lit(None)).otherwise(F.col(c)) for c in cols})


def zero_shares_audit(df: DataFrame, columns=S.ZERO_WIPEOUT, date: str = "m_date") -> DataFrame:
    cols = S.present(df, columns)
    if not cols or "m_volume" not in df.columns:
        return no_rows(df, "zero_wipeout_logs")
    anyzero = F.lit(False)
    for c in cols:
        anyzero = anyzero | (F.col(c) == 0)
    bad = df.where(anyzero & (F.col("m_volume") > 0)).select(
        "ticker", "seq", date, "m_volume", *cols)
    rows = by_quarter(bad, [], {
        "volume": F.min_by("m_volume", "seq"),
        "affected": F.array_compact(F.array(
            *[F.when(F.min(c) == 0, F.lit(c)) for c in cols])),
    }, date)
    return audit_rows(rows, "zero_wipeout_logs", {
        **quarter_fields(),
        "error_type": F.lit("zero_with_volume"),
        "column": F.array_join("affected", ", "),
        "original_value": F.lit(0.0),
        "method": F.lit("forward_fill"),
        "message": F.concat(F.lit("Zero shares with positive volume ("),
                            F.col("volume").cast("string"), F.lit(")")),
    }, {"volume": F.col("volume")})


# -- tenfold jumps ----------------------------------------------------------------------------------
def _jump(value: Column, previous: Column, guard_positive: bool) -> Column:
    """At least ten times the previous row; optionally only over a positive previous value."""
    flag = value >= previous * 10
    return flag & (previous > 0) if guard_positive else flag


def flag_jumps(df: DataFrame, layout: Layout, columns, guard_positive: bool = False) -> DataFrame:
    """Add ``_jump_<column>`` flags computed from the values as they are."""
    prev = layout.lag(df, {f"_prev_{c}": F.col(c) for c in columns})
    return prev.withColumns({
        f"_jump_{c}": _jump(F.col(c), F.col(f"_prev_{c}"), guard_positive) for c in columns
    }).drop(*[f"_prev_{c}" for c in columns])


def fill_jumps(df: DataFrame, layout: Layout, columns=S.SCALE_JUMP,
               shares: str = S.DILUTED_SHARES, guard_positive: bool = False) -> DataFrame:
    """A tenfold jump becomes the last value before it, column by column.

    The lag looks at original values, so only the first row of a new plateau is replaced.
    ``shares`` is left to :func:`fill_correlated_jumps`.
    """
    cols = [c for c in S.present(df, columns) if c != shares]
    if not cols:
        return df
    flagged = flag_jumps(df, layout, cols, guard_positive)
    out = layout.last_valid(flagged, {
        c: F.when(F.col(f"_jump_{c}"), F.lit(None)).otherwise(F.col(c)) for c in cols})
    return out.drop(*[f"_jump_{c}" for c in cols])


def fill_correlated_jumps(df: DataFrame, layout: Layout, market_cap: str = "c_market_cap",
                          shares: str = S.DILUTED_SHARES) -> DataFrame:
    """Where market cap and shares jump together, shares become the last value before."""
    flagged = flag_jumps(df, layout, [market_cap, shares])
    both = F.col(f"_jump_{market_cap}") & F.col(f"_jump_{shares}")
    out = layout.last_valid(flagged, {
        shares: F.when(both, F.lit(None)).otherwise(F.col(shares))})
    return out.drop(f"_jump_{market_cap}", f"_jump_{shares}")


def jump_audit(df: DataFrame, layout: Layout, columns=S.SCALE_JUMP,
               date: str = "m_date") -> DataFrame:
    """Per quarter: span, number of jump rows and which columns jumped."""
    cols = S.present(df, columns)
    if not cols:
        return no_rows(df, "shares_outstanding_logs")
    flags = [f"_jump_{c}" for c in cols]
    anyjump = F.lit(False)
    for f in flags:
        anyjump = anyjump | F.col(f)
    flagged = flag_jumps(df.select("ticker", "seq", date, *cols), layout, cols)
    rows = by_quarter(flagged.where(anyjump), [], {
        "affected": F.array_compact(F.array(
            *[F.when(F.bool_or(f), F.lit(c)) for c, f in zip(cols, flags)])),
    }, date)
    return audit_rows(rows, "shares_outstanding_logs", {
        **quarter_fields(),
        "error_type": F.lit("scale_10x_jump"),
        "column": F.array_join("affected", ", "),
        "method": F.lit("forward_fill"),
        "message": F.lit("10x scale jump detected and corrected"),
    })
