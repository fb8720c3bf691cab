"""User calculations: functions named ``c_*`` whose arguments are column names.

A calculation takes and returns Columns, so adding one costs no Python at run time. Results
may feed later calculations. Two things a plain Column cannot say on its own are declared:

* an argument's default can ask for a view of the column instead of its plain values:
  ``NONNEGATIVE`` (negatives replaced by the last non-negative value) or ``Previous("x")``
  (the row before in ticker order);
* ``FillForward(expr)`` as a result means nulls take the last non-null value before them.

Views and fills of one dependency level are evaluated together, so they share one window.
"""

from __future__ import annotations

import inspect
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelmend import schema as S
from panelmend.functions import identities as I
from panelmend.layout import Layout


@dataclass(frozen=True)
class FillForward:
    expr: Column


@dataclass(frozen=True)
class Previous:
    column: str


NONNEGATIVE = object()


@dataclass(frozen=True)
class Calculation:
    """A named output, the columns it reads (with the view of each) and how to combine them."""

    name: str
    inputs: tuple[tuple[str, object], ...]
    combine: Callable

    @staticmethod
    def of(fn: Callable) -> "Calculation":
        if isinstance(fn, Calculation):
            return fn
        if not fn.__name__.startswith("c_"):
            raise ValueError(f"calculation {fn.__name__!r} must start with c_")
        params = inspect.signature(fn).parameters.values()
        return Calculation(fn.__name__, tuple(
            (p.name, None if p.default is p.empty else p.default) for p in params), fn)

    def reads(self) -> set[str]:
        return {v.column if isinstance(v, Previous) else n for n, v in self.inputs}


def _levels(calcs: list[Calculation], have: set[str]) -> list[list[Calculation]]:
    """Dependency levels; everything in one level only reads what is already there."""
    have, left, levels = set(have), list(calcs), []
    while left:
        ready = [c for c in left if c.reads() <= have]
        if not ready:
            missing = {c.name: sorted(c.reads() - have) for c in left}
            raise ValueError(f"calculations with unknown or circular inputs: {missing}")
        levels.append(ready)
        have |= {c.name for c in ready}
        left = [c for c in left if c not in ready]
    return levels


def with_calculations(df: DataFrame, calculations: Iterable, layout: Layout) -> DataFrame:
    """Add one column per calculation, in dependency order."""
    calcs = [Calculation.of(c) for c in calculations]
    temporary: set[str] = set()
    for level in _levels(calcs, set(df.columns)):
        used = [(n, v) for c in level for n, v in c.inputs]
        previous = {f"_prev_{v.column}": F.col(v.column) for _, v in used
                    if isinstance(v, Previous)}
        nonneg = {f"_nonneg_{n}": F.when(F.col(n) >= 0, F.col(n)) for n, v in used
                  if v is NONNEGATIVE}
        previous = {n: e for n, e in previous.items() if n not in temporary}
        nonneg = {n: e for n, e in nonneg.items() if n not in temporary}
        if previous:
            df = layout.lag(df, previous)
        if nonneg:
            df = layout.last_valid(df, nonneg)
        temporary |= set(previous) | set(nonneg)

        def argument(name, view):
            if isinstance(view, Previous):
                return F.col(f"_prev_{view.column}")
            return F.col(f"_nonneg_{name}" if view is NONNEGATIVE else name)

        results = {c.name: c.combine(*[argument(n, v) for n, v in c.inputs]) for c in level}
        plain = {n: e for n, e in results.items() if not isinstance(e, FillForward)}
        filled = {n: e.expr for n, e in results.items() if isinstance(e, FillForward)}
        if plain:
            df = df.withColumns(plain)
        if filled:
            df = layout.last_valid(df, filled)
    return df.drop(*temporary)


# -- ready-made calculations -----------------------------------------------------------------------
def _vwap(o, h, l, c, v):
    top, bottom = F.greatest(o, h, l, c), F.least(o, h, l, c)
    return F.when((v < bottom) | (v > top), (o + top + bottom + c) / 4.0).otherwise(v)


def _market(suffix: str) -> list[Calculation]:
    def inputs(*names):
        return tuple((f"m_{n}{suffix}", NONNEGATIVE) for n in names)

    ohlc = ("open", "high", "low", "close")
    made = [
        ("high", ohlc, lambda o, h, l, c: F.when(h.isNotNull(), F.greatest(o, h, l, c))),
        ("low", ohlc, lambda o, h, l, c: F.when(l.isNotNull(), F.least(o, h, l, c))),
        ("vwap", (*ohlc, "vwap"), _vwap),
        ("open", ("open",), lambda c: c),
        ("close", ("close",), lambda c: c),
        ("volume", ("volume",), lambda c: c),
    ]
    return [Calculation(f"c_fixed_{n}{suffix}", inputs(*reads), fn) for n, reads, fn in made]


def _balance(kind: str) -> list[Calculation]:
    total, current, noncurrent = (f"fbs_{p}{kind}" for p in ("", "current_", "noncurrent_"))
    reads = tuple((c, None) for c in (total, current, noncurrent))

    def part(i):
        def combine(t, c, n):
            bad = I.off_by(t, c + n)
            scaled = F.when(c + n != 0, (c, n)[i] * F.try_divide(t, c + n))
            return F.when(bad, scaled.otherwise((F.lit(0.0), t)[i])).otherwise((c, n)[i])
        return combine

    return [Calculation(f"c_fixed_{p}{kind}", reads, part(i))
            for i, p in enumerate(("current_", "noncurrent_"))]


def _shares(name: str, column: str) -> list[Calculation]:
    def zeros(shares, volume):
        return FillForward(F.when((shares == 0) & (volume > 0), F.lit(None)).otherwise(shares))

    def jumps(shares, previous):
        jump = (shares >= previous * 10) & (previous > 0)
        return FillForward(F.when(jump, F.lit(None)).otherwise(shares))

    return [Calculation(f"c_fixed_{name}_shares", ((column, None), ("m_volume", None)), zeros),
            Calculation(f"c_fixed_{name}_shares_scale",
                        ((column, None), ("previous", Previous(column))), jumps)]


def c_data_warning(fbs_stockholder_equity, fbs_common_stock_value,
                   fbs_additional_paid_in_capital, fbs_retained_earnings,
                   fbs_other_stockholder_equity, fbs_assets, fbs_liabilities,
                   fbs_noncontrolling_interest):
    """Equity or accounting-equation mismatch; what cannot be evaluated does not warn."""
    parts = (fbs_common_stock_value + fbs_additional_paid_in_capital + fbs_retained_earnings
             + fbs_other_stockholder_equity)
    owed = (fbs_liabilities + fbs_stockholder_equity
            + F.coalesce(fbs_noncontrolling_interest, F.lit(0.0)))
    no = F.lit(False)
    return (F.coalesce(I.off_by(fbs_stockholder_equity, parts), no)
            | F.coalesce(I.off_by(fbs_assets, owed), no))


def c_test(m_open, m_close):
    return m_close - m_open


MARKET = {c.name: c for a in S.ADJUSTMENTS for c in _market(a)}
BALANCE = {c.name: c for k in ("assets", "liabilities") for c in _balance(k)}
SHARES = {c.name: c for n, col in (("basic", S.BASIC_SHARES), ("diluted", S.DILUTED_SHARES))
          for c in _shares(n, col)}
CALCULATIONS = {**MARKET, **BALANCE, **SHARES,
                **{f.__name__: Calculation.of(f) for f in (c_data_warning, c_test)}}
