"""Price-bar integrity and split consistency."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelmend import schema as S
from panelmend.layout import Layout
from panelmend.operators.audit_rows import audit_rows, first_per, no_rows

# fixed values: labels of the three price groups
GROUP_NAMES = dict(zip(S.ADJUSTMENTS, ("raw", "split_adjusted", "dividend_and_split_adjusted")))


# -- open / high / low / close / vwap ---------------------------------------------------------
@dataclass(frozen=True)
class Bar:
    """One group of price columns and the three tests on its values as they are."""

    suffix: str
    has_vwap: bool

    def col(self, name: str) -> Column:
        return F.col(f"m_{name}{self.suffix}")

    def _prices(self):
        return [self.col(n) for n in ("open", "high", "low", "close")]

    def top(self) -> Column:
        return F.greatest(*self._prices())

    def bottom(self) -> Column:
        return F.least(*self._prices())

    def centroid(self) -> Column:
        o, h, l, c = self._prices()
        return (o + h + l + c) / 4.0

    def checks(self) -> list[tuple[str, str, Column, Column]]:
        """(value, error type, violated?, replacement)."""
        v, h, l = self.col("vwap"), self.col("high"), self.col("low")
        out = [("high", "high_not_maximum", h < self.top(), self.top()),
               ("low", "low_not_minimum", l > self.bottom(), self.bottom())]
        if self.has_vwap:
            out.append(("vwap", "vwap_outside_range", (v < l) | (v > h), self.centroid()))
        return out


def bars_of(df: DataFrame) -> list[Bar]:
    have = set(df.columns)
    return [Bar(a, f"m_vwap{a}" in have) for a in S.ADJUSTMENTS
            if {f"m_{n}{a}" for n in ("open", "high", "low", "close")} <= have]


def repair_ohlc(df: DataFrame) -> DataFrame:
    """High up to the maximum, low down to the minimum, vwap back inside the day's range."""
    fixed = {}
    for bar in bars_of(df):
        for value, _, bad, new in bar.checks():
            fixed[f"m_{value}{bar.suffix}"] = F.when(bad, new).otherwise(bar.col(value))
    return df.withColumns(fixed) if fixed else df


def ohlc_audit(df: DataFrame, date: str = "m_date") -> DataFrame:
    """One row per broken test with old and new value."""
    found = []
    for bar in bars_of(df):
        for value, error, bad, new in bar.checks():
            label = {"high": "High", "low": "Low", "vwap": "VWAP"}[value]
            tail = " (OHLC centroid)" if value == "vwap" else ""
            found.append(F.when(bad, F.struct(
                F.lit(len(found)).alias("rank"), F.lit(error).alias("error"),
                F.lit(f"m_{value} ({GROUP_NAMES[bar.suffix]})").alias("column"),
                bar.col(value).alias("old"), new.alias("new"),
                F.concat(F.lit(f"{label} corrected from "), bar.col(value).cast("string"),
                         F.lit(" to "), new.cast("string"), F.lit(tail)).alias("message"),
                *[bar.col(n).alias(n) for n in ("open", "high", "low", "close")],
                (bar.col("vwap") if bar.has_vwap else F.lit(None).cast("double")).alias("vwap"))))
    if not found:
        return no_rows(df, "ohlc_logs")
    hits = (df.select("ticker", "seq", date, F.explode(F.array_compact(F.array(*found))).alias("e"))
            .select("ticker", "seq", date, "e.*"))
    rows = first_per(hits, ["ticker"], [F.col("seq"), F.col("rank")])
    return audit_rows(rows, "ohlc_logs", {
        "error_type": F.col("error"), "date": F.col(date), "column": F.col("column"),
        "original_value": F.col("old"), "corrected_value": F.col("new"),
        "message": F.col("message"),
    }, {n: F.col(n) for n in ("open", "high", "low", "close", "vwap")})


# -- splits --------------------------------------------------------------------------------------
def split_factor(df_columns=S.SPLIT_EVENT) -> Column:
    """Daily factor denominator / numerator; 1 where no split is declared."""
    num, den = [F.col(c).cast("double") for c in df_columns]
    declared = num.isNotNull() & den.isNotNull() & (num != 0) & (den != 0)
    return F.when(declared, F.try_divide(den, num)).otherwise(F.lit(1.0))


def with_split_k(df: DataFrame, layout: Layout, out: str = "k_expected") -> DataFrame:
    """Cumulative split factor, summed in logs; null from a nonsensical factor onwards."""
    f = split_factor()
    sums = layout.running_sum(df, {
        "_logk": F.when(f > 0, F.log(f)), "_badk": F.when(f <= 0, F.lit(1))})
    return sums.withColumn(out, F.when(F.col("_badk") == 0, F.exp("_logk"))).drop(
        "_logk", "_badk")


@dataclass(frozen=True)
class SplitPair:
    """A raw column, its adjusted column, and how the two relate through K."""

    raw: str
    adjusted: str
    volume: bool = False

    def implied(self) -> Column:
        raw, adj = F.col(self.raw), F.col(self.adjusted)
        return F.try_divide(raw, adj) if self.volume else F.try_divide(adj, raw)

    def deviation(self) -> Column:
        return F.abs(self.implied() - F.col("k_expected"))

    def violated(self, tolerance: float) -> Column:
        return self.deviation() > F.abs(F.col("k_expected")) * tolerance

    def corrected(self) -> Column:
        raw, k = F.col(self.raw), F.col("k_expected")
        return F.try_divide(raw, k) if self.volume else raw * k

    @property
    def error(self) -> str:
        return "volume_split_mismatch" if self.volume else "price_split_mismatch"


def _wanted_pairs(columns) -> list[SplitPair]:
    pairs = [SplitPair(r, a) for r, a in S.SPLIT_PRICES] + [SplitPair(*S.SPLIT_VOLUME, True)]
    if columns is None:
        return pairs
    asked = set(columns)
    return [p for p in pairs if p.raw in asked or p.adjusted in asked]


def split_pairs(df: DataFrame, columns=None) -> list[SplitPair]:
    have = set(df.columns)
    if not set(S.SPLIT_EVENT) <= have:
        return []
    return [p for p in _wanted_pairs(columns) if p.raw in have and p.adjusted in have]


def repair_splits(df: DataFrame, layout: Layout, tolerance: float = 0.01,
                  columns=None) -> DataFrame:
    """Recompute adjusted values that disagree with the declared splits."""
    pairs = split_pairs(df, columns)
    if not pairs:
        return df
    return with_split_k(df, layout).withColumns({
        p.adjusted: F.when(p.violated(tolerance), F.coalesce(p.corrected(), F.col(p.adjusted)))
        .otherwise(F.col(p.adjusted)) for p in pairs}).drop("k_expected")


def split_audit(df: DataFrame, layout: Layout, tolerance: float = 0.01, columns=None,
                date: str = "m_date") -> DataFrame:
    """One row per mismatch with expected and implied K."""
    pairs = split_pairs(df, columns)
    if not pairs:
        return no_rows(df, "split_inconsistencies_logs")
    found = [F.when(p.violated(tolerance), F.struct(
        F.lit(i).alias("rank"), F.lit(p.error).alias("error"),
        F.lit(f"{p.raw}/{p.adjusted}").alias("column"), F.col(p.raw).alias("raw"),
        F.col(p.adjusted).alias("old"), p.corrected().alias("new"),
        p.implied().alias("implied"), p.deviation().alias("deviation")))
        for i, p in enumerate(pairs)]
    hits = (with_split_k(df, layout).withColumn("daily", split_factor())
            .select("ticker", "seq", date, "k_expected", "daily",
                    F.explode(F.array_compact(F.array(*found))).alias("e"))
            .select("ticker", "seq", date, "k_expected", "daily", "e.*"))
    rows = first_per(hits, ["ticker"], [F.col("seq"), F.col("rank")])
    return audit_rows(rows, "split_inconsistencies_logs", {
        "error_type": F.col("error"), "date": F.col(date), "column": F.col("column"),
        "original_value": F.col("old"), "corrected_value": F.col("new"),
        "severity": F.col("deviation"), "threshold": F.lit(tolerance),
        "method": F.lit("recalculated_from_k_expected"),
        "message": F.format_string("Split mismatch: K_expected=%.6f, K_implied=%.6f",
                                   "k_expected", "implied"),
    }, {"raw_value": F.col("raw"), "k_expected": F.col("k_expected"),
        "k_implied": F.col("implied"), "daily_split_factor": F.col("daily")})


def split_skipped(df: DataFrame, columns=None) -> DataFrame:
    """Info rows for pairs, or the whole check, that missing columns rule out.

    What is missing is a property of the schema, so only the ticker list comes from data.
    """
    have = set(df.columns)
    notes = []
    if not set(S.SPLIT_EVENT) <= have:
        notes.append(("skipped_validation", "missing_split_columns",
                      [c for c in S.SPLIT_EVENT if c not in have]))
    else:
        wanted = _wanted_pairs(columns)
        for p in wanted:
            missing = [c for c in (p.raw, p.adjusted) if c not in have]
            if missing:
                notes.append(("skipped_pair", "missing_columns", missing))
        if not split_pairs(df, columns):
            notes.append(("skipped_validation", "no_valid_pairs_available", []))
    tickers = df.select("ticker").distinct()
    if not notes:
        return no_rows(tickers, "split_inconsistencies_logs")
    items = F.array(*[F.struct(
        F.lit(e).alias("error"), F.lit(r).alias("reason"), F.lit(", ".join(m)).alias("missing"))
        for e, r, m in notes])
    rows = tickers.select("ticker", F.explode(items).alias("n")).select("ticker", "n.*")
    return audit_rows(rows, "split_inconsistencies_logs", {
        "error_type": F.col("error"), "filter_type": F.lit("info"),
        "column": F.col("missing"), "method": F.col("reason"),
        "message": F.format_string("Skipped: %s. Missing: [%s]", "reason", "missing"),
    })
