"""Accounting identities as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from panelmend.schema import EQUITY_PARTS

TOLERANCE = 0.05


def off_by(total: Column, parts: Column, tolerance: float = TOLERANCE) -> Column:
    """The two sides differ by more than ``tolerance`` of the total."""
    return F.abs(total - parts) > F.abs(total) * tolerance


def balance_violated(total: str, current: str, noncurrent: str,
                     tolerance: float = TOLERANCE) -> Column:
    return off_by(F.col(total), F.col(current) + F.col(noncurrent), tolerance)


def balanced_parts(total: str, current: str, noncurrent: str) -> tuple[Column, Column]:
    """Both parts scaled to the total; all of it to noncurrent when the parts sum to zero."""
    t, c, n = F.col(total), F.col(current), F.col(noncurrent)
    parts = c + n
    factor = F.try_divide(t, parts)
    nonzero = parts != 0
    return (F.when(nonzero, c * factor).otherwise(F.lit(0.0)),
            F.when(nonzero, n * factor).otherwise(t))


def equity_mismatch(tolerance: float = TOLERANCE) -> Column:
    a, b, c, d = [F.col(x) for x in EQUITY_PARTS]
    return off_by(F.col("fbs_stockholder_equity"), a + b + c + d, tolerance)


def cash_mismatch(tolerance: float = TOLERANCE) -> Column:
    return off_by(F.col("fcf_period_end_cash"), F.col("fbs_cash_and_cash_equivalents"),
                  tolerance)


def claims() -> Column:
    """Liabilities + equity + noncontrolling interest, a missing interest counting as zero."""
    return (F.col("fbs_liabilities") + F.col("fbs_stockholder_equity")
            + F.coalesce(F.col("fbs_noncontrolling_interest"), F.lit(0.0)))


def accounting_equation_mismatch(tolerance: float = TOLERANCE) -> Column:
    return off_by(F.col("fbs_assets"), claims(), tolerance)
