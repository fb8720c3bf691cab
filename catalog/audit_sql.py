"""Audit rows of the rules as DuckDB SQL, for checking."""

from __future__ import annotations

from panelmend.schema import RULES

# text or numbers that both engines print alike are compared; message and payload are not
FIELDS = {
    "stage": "varchar", "rule": "varchar", "category": "varchar", "error_type": "varchar",
    "filter_type": "varchar", "ticker": "varchar", "date": "date", "date_start": "date",
    "date_end": "date", "quarter": "varchar", "column": "varchar", "original_value": "double",
    "corrected_value": "double", "severity": "double", "threshold": "double",
    "method": "varchar", "count": "bigint",
}


def audit_select(rule: str, source: str, **given: str) -> str:
    stage, category = RULES[rule]
    given = {"stage": f"'{stage}'", "rule": f"'{rule}'", "category": f"'{category}'",
             "filter_type": "'correction'", "ticker": "ticker", **given}
    cols = ", ".join(f'cast({given.get(f, "null")} as {t}) as "{f}"' for f, t in FIELDS.items())
    return f"select {cols} from {source}"


def first_per(source: str, keys: str, order: str, n: int | None = None) -> str:
    if n is None:
        return f"(select * from {source})"
    return (f"(select * from (select *, row_number() over (partition by {keys} order by {order}) "
            f"as rn_ from {source}) where rn_ <= {n})")


def by_quarter(source: str, keys: str, aggs: str) -> str:
    """Quarters of flagged rows; ``keys`` starts with a comma when not empty."""
    inner = (f"(select ticker{keys}, year(m_date) || '-Q' || quarter(m_date) as quarter, "
             f"min(m_date) as date_start, max(m_date) as date_end, count(*) as n, {aggs} "
             f"from {source} group by ticker{keys}, year(m_date) || '-Q' || quarter(m_date))")
    return first_per(inner, f"ticker{keys}", "date_start nulls first, quarter")


QUARTER = {"date_start": "date_start", "date_end": "date_end", "quarter": "quarter", "count": "n"}


def negative_statements(source: str, columns: list[str]) -> str:
    rows = " union all ".join(
        f"select ticker, seq, m_date, '{c}' as col, {c} as v from {source} where {c} < 0"
        for c in columns)
    return audit_select(
        "negative_fundamentals_logs", by_quarter(f"({rows})", ", col", "min_by(v, seq) as v"),
        **QUARTER, error_type="'negative_value'", column="col", original_value="v",
        method="'forward_fill'")


def zero_shares(source: str, columns: list[str]) -> str:
    cond = " or ".join(f"{c} = 0" for c in columns)
    affected = "concat_ws(', ', " + ", ".join(
        f"case when min({c}) = 0 then '{c}' end" for c in columns) + ") as affected"
    return audit_select(
        "zero_wipeout_logs",
        by_quarter(f"(select * from {source} where ({cond}) and m_volume > 0)", "", affected),
        **QUARTER, error_type="'zero_with_volume'", column="affected", original_value="0",
        method="'forward_fill'")


def jumps(source: str, columns: list[str]) -> str:
    flags = ", ".join(
        f"{c} >= 10 * lag({c}) over (partition by ticker order by seq) as j{i}"
        for i, c in enumerate(columns))
    anyflag = " or ".join(f"j{i}" for i in range(len(columns)))
    affected = "concat_ws(', ', " + ", ".join(
        f"case when bool_or(j{i}) then '{c}' end" for i, c in enumerate(columns)) + ") as affected"
    return audit_select(
        "shares_outstanding_logs",
        by_quarter(f"(select * from (select ticker, seq, m_date, {flags} from {source}) "
                   f"where {anyflag})", "", affected),
        **QUARTER, error_type="'scale_10x_jump'", column="affected", method="'forward_fill'")


OHLC_GROUPS = {"": "raw", "_split_adjusted": "split_adjusted",
               "_dividend_and_split_adjusted": "dividend_and_split_adjusted"}


def ohlc(source: str) -> str:
    parts, rank = [], 0
    for suffix, name in OHLC_GROUPS.items():
        o, h, l, c, v = (f"m_{x}{suffix}" for x in ("open", "high", "low", "close", "vwap"))
        top, bottom = f"greatest({o}, {h}, {l}, {c})", f"least({o}, {h}, {l}, {c})"
        for value, error, bad, new in (
                ("high", "high_not_maximum", f"{h} < {top}", top),
                ("low", "low_not_minimum", f"{l} > {bottom}", bottom),
                ("vwap", "vwap_outside_range", f"{v} < {l} or {v} > {h}",
                 f"({o} + {h} + {l} + {c}) / 4.0e0")):
            parts.append(
                f"select ticker, seq, m_date, {rank} as rk, '{error}' as err, "
                f"'m_{value} ({name})' as col, m_{value}{suffix} as old, {new} as new "
                f"from {source} where {bad}")
            rank += 1
    hits = "(" + " union all ".join(parts) + ")"
    return audit_select("ohlc_logs", first_per(hits, "ticker", "seq, rk"), error_type="err",
                        date="m_date", column="col", original_value="old", corrected_value="new")


BALANCES = {
    "assets_mismatch": ("fbs_assets", "fbs_current_assets", "fbs_noncurrent_assets"),
    "liabilities_mismatch": ("fbs_liabilities", "fbs_current_liabilities",
                             "fbs_noncurrent_liabilities")}


def balances(source: str) -> str:
    parts = " union all ".join(
        f"select ticker, seq, m_date, '{e}' as err, '{'/'.join(cols)}' as col, {cols[0]} as t, "
        f"{cols[1]} + {cols[2]} as parts from {source} "
        f"where abs({cols[0]} - ({cols[1]} + {cols[2]})) > abs({cols[0]}) * 0.05e0"
        for e, cols in BALANCES.items())
    src = by_quarter(f"({parts})", ", err",
                     "min_by(t, seq) as t, min_by(parts, seq) as parts, min(col) as col")
    return audit_select(
        "financial_unequivalencies_logs", src, **QUARTER, error_type="err",
        filter_type="'hard_error'", column="col", original_value="parts", corrected_value="t",
        severity="abs(t - parts)", threshold="0.05e0",
        method="case when parts <> 0 then 'proportional_scaling' else 'residual_plug' end")


EQUITY = ("fbs_common_stock_value + fbs_additional_paid_in_capital + fbs_retained_earnings "
          "+ fbs_other_stockholder_equity")
CLAIMS = ("fbs_liabilities + fbs_stockholder_equity + coalesce(fbs_noncontrolling_interest, 0e0)")
WARNINGS = {
    "equity_mismatch": ("fbs_stockholder_equity", "fbs_stockholder_equity", f"({EQUITY})"),
    "cash_mismatch": ("fcf_period_end_cash/fbs_cash_and_cash_equivalents",
                      "fcf_period_end_cash", "fbs_cash_and_cash_equivalents"),
    "accounting_equation_mismatch": (
        "fbs_assets/fbs_liabilities/fbs_stockholder_equity/fbs_noncontrolling_interest",
        "fbs_assets", f"({CLAIMS})"),
}


def warnings(source: str) -> str:
    parts = " union all ".join(
        f"select ticker, seq, m_date, '{e}' as err, '{col}' as col, {t} as t, {p} as parts "
        f"from {source} where abs({t} - {p}) > abs({t}) * 0.05e0"
        for e, (col, t, p) in WARNINGS.items())
    src = by_quarter(f"({parts})", ", err",
                     "min_by(t, seq) as t, min_by(parts, seq) as parts, min(col) as col")
    return audit_select(
        "financial_unequivalencies_logs", src, **QUARTER, error_type="err",
        filter_type="'soft_warning'", column="col", original_value="t",
        severity="abs(t - parts)", threshold="0.05e0")
