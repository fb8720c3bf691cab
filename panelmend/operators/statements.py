"""Statement identities: repairs (hard), warnings (soft) and their audit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelmend import schema as S
from panelmend.functions import identities as I
from panelmend.operators.audit_rows import audit_rows, no_rows
from panelmend.operators.statement_repairs import by_quarter, quarter_fields

# fixed values: error type -> (total, current part, noncurrent part)
BALANCES = {
    "assets_mismatch": ("fbs_assets", "fbs_current_assets", "fbs_noncurrent_assets"),
    "liabilities_mismatch": ("fbs_liabilities", "fbs_current_liabilities",
                             "fbs_noncurrent_liabilities"),
}
# fixed values: error type -> columns the check needs, column text shown to reviewers
WARNINGS = {
    "equity_mismatch": (["fbs_stockholder_equity", *S.EQUITY_PARTS], "fbs_stockholder_equity"),
    "cash_mismatch": (["fcf_period_end_cash", "fbs_cash_and_cash_equivalents"],
                      "fcf_period_end_cash/fbs_cash_and_cash_equivalents"),
    "accounting_equation_mismatch": (
        ["fbs_assets", "fbs_liabilities", "fbs_stockholder_equity",
         "fbs_noncontrolling_interest"],
        "fbs_assets/fbs_liabilities/fbs_stockholder_equity/fbs_noncontrolling_interest"),
}
FLAGS = {"equity_mismatch": I.equity_mismatch, "cash_mismatch": I.cash_mismatch,
         "accounting_equation_mismatch": I.accounting_equation_mismatch}


def _balances(df: DataFrame) -> dict:
    have = set(df.columns)
    return {e: c for e, c in BALANCES.items() if set(c) <= have}


def _warnings(df: DataFrame) -> list[str]:
    have = set(df.columns)
    return [e for e, (cols, _) in WARNINGS.items() if set(cols) <= have]


def repair_balances(df: DataFrame, tolerance: float = I.TOLERANCE) -> DataFrame:
    """Scale current and noncurrent parts to their total where they miss it."""
    fixed = {}
    for total, current, noncurrent in _balances(df).values():
        bad = I.balance_violated(total, current, noncurrent, tolerance)
        new_current, new_noncurrent = I.balanced_parts(total, current, noncurrent)
        fixed[current] = F.when(bad, new_current).otherwise(F.col(current))
        fixed[noncurrent] = F.when(bad, new_noncurrent).otherwise(F.col(noncurrent))
    return df.withColumns(fixed) if fixed else df


def add_data_warning(df: DataFrame, tolerance: float = I.TOLERANCE) -> DataFrame:
    """``data_warning``: any soft check fails; null when that cannot be told."""
    flag = F.lit(False)
    for error in _warnings(df):
        flag = flag | FLAGS[error](tolerance)
    return df.withColumn("data_warning", flag)


def balance_audit(df: DataFrame, tolerance: float = I.TOLERANCE,
                  date: str = "m_date") -> DataFrame:
    """Per kind and quarter: first total and parts, what they became and how."""
    found = []
    for error, cols in _balances(df).items():
        total, current, noncurrent = cols
        new_current, new_noncurrent = I.balanced_parts(*cols)
        found.append(F.when(I.balance_violated(*cols, tolerance), F.struct(
            F.lit(error).alias("error_type"), F.lit("/".join(cols)).alias("column"),
            F.col(total).alias("total"), F.col(current).alias("current"),
            F.col(noncurrent).alias("noncurrent"), new_current.alias("corrected_current"),
            new_noncurrent.alias("corrected_noncurrent"))))
    if not found:
        return no_rows(df, "financial_unequivalencies_logs")
    hits = (df.select("ticker", "seq", date,
                      F.explode(F.array_compact(F.array(*found))).alias("e"))
            .select("ticker", "seq", date, "e.error_type", "e"))
    rows = by_quarter(hits, ["error_type"], {"e": F.min_by("e", "seq")}, date)
    parts = F.col("e.current") + F.col("e.noncurrent")
    return audit_rows(rows, "financial_unequivalencies_logs", {
        **quarter_fields(),
        "error_type": F.col("error_type"), "filter_type": F.lit("hard_error"),
        "column": F.col("e.column"), "original_value": parts,
        "corrected_value": F.col("e.total"),
        "severity": F.abs(F.col("e.total") - parts),
        "threshold": F.lit(tolerance),
        "method": F.when(parts != 0, "proportional_scaling").otherwise("residual_plug"),
        "message": F.concat(
            F.when(F.col("error_type") == "assets_mismatch", "Assets")
            .otherwise("Liabilities"), F.lit(" mismatch: Total="),
            F.col("e.total").cast("string"), F.lit(", Current+Noncurrent="),
            parts.cast("string"), F.lit(", Diff="),
            (F.col("e.total") - parts).cast("string")),
    }, {"total": F.col("e.total"), "current": F.col("e.current"),
        "noncurrent": F.col("e.noncurrent"), "component_sum": parts,
        "difference": F.col("e.total") - parts,
        "corrected_current": F.col("e.corrected_current"),
        "corrected_noncurrent": F.col("e.corrected_noncurrent")})


def _sides(error: str) -> tuple[Column, Column]:
    """The two sides a warning compares, as reported (missing claims count as zero)."""
    if error == "cash_mismatch":
        return F.col("fcf_period_end_cash"), F.col("fbs_cash_and_cash_equivalents")
    if error == "equity_mismatch":
        a, b, c, d = [F.col(x) for x in S.EQUITY_PARTS]
        return F.col("fbs_stockholder_equity"), a + b + c + d
    zero = F.lit(0.0)
    l, e, n = [F.coalesce(F.col(c), zero) for c in WARNINGS[error][0][1:]]
    return F.col("fbs_assets"), l + e + n


def warning_audit(df: DataFrame, tolerance: float = I.TOLERANCE,
                  date: str = "m_date") -> DataFrame:
    """Per soft check and quarter: both sides, their difference and the component values."""
    found = []
    for error in _warnings(df):
        cols, shown = WARNINGS[error]
        total, parts = _sides(error)
        entries = []
        for c in cols:
            entries += [F.lit(c), F.col(c).cast("string")]
        found.append(F.when(FLAGS[error](tolerance), F.struct(
            F.lit(error).alias("error_type"), F.lit(shown).alias("column"),
            total.alias("total"), parts.alias("parts"),
            F.to_json(F.create_map(*entries)).alias("components"))))
    if not found:
        return no_rows(df, "financial_unequivalencies_logs")
    hits = (df.select("ticker", "seq", date,
                      F.explode(F.array_compact(F.array(*found))).alias("e"))
            .select("ticker", "seq", date, "e.error_type", "e"))
    rows = by_quarter(hits, ["error_type"], {"e": F.min_by("e", "seq")}, date)
    diff = F.col("e.total") - F.col("e.parts")
    label = (F.when(F.col("error_type") == "equity_mismatch", "Equity mismatch: Total=")
             .when(F.col("error_type") == "cash_mismatch", "Cash mismatch: Period End Cash=")
             .otherwise("A!=L+E+NCI: Assets="))
    mid = (F.when(F.col("error_type") == "equity_mismatch", ", Sum=")
           .when(F.col("error_type") == "cash_mismatch", ", Cash & Equiv=")
           .otherwise(", Claims="))
    return audit_rows(rows, "financial_unequivalencies_logs", {
        **quarter_fields(),
        "error_type": F.col("error_type"), "filter_type": F.lit("soft_warning"),
        "column": F.col("e.column"), "original_value": F.col("e.total"),
        "severity": F.abs(diff), "threshold": F.lit(tolerance),
        "message": F.concat(label, F.col("e.total").cast("string"), mid,
                            F.col("e.parts").cast("string"), F.lit(", Diff="),
                            diff.cast("string")),
    }, {"total": F.col("e.total"), "component_sum": F.col("e.parts"), "difference": diff,
        "components": F.col("e.components")})
