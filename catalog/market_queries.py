"""Queries for market repairs, splits and column calculations."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import audit_sql as A
from catalog import fixtures as X
from catalog.ordered_queries import _ffill, slim
from catalog.registry import cte, query, snap, snap_sql
from panelmend import schema as S
from panelmend.functions.calculations import CALCULATIONS, with_calculations
from panelmend.operators import market, negative_prices
from panelmend.workspace import Workspace

PRICES = [f"m_{n}{a}" for a in S.ADJUSTMENTS for n in ("open", "high", "low", "close", "vwap")]
NEGATIVE = list(S.NONNEGATIVE_MARKET)

# -- negative market values ---------------------------------------------------------------------
# Steps through every series row by row; the state is the last four valid points.
_POINT = "struct_pack(x := cast({x} as double), y := cast({y} as double))"


def _lagrange(n: int) -> str:
    terms = []
    for i in range(1, n + 1):
        top = " * ".join(f"(seq - m[{j}].x)" for j in range(1, n + 1) if j != i)
        low = " * ".join(f"(m[{i}].x - m[{j}].x)" for j in range(1, n + 1) if j != i)
        terms.append(f"m[{i}].y * ({top}) / ({low})")
    return " + ".join(terms)


def _stepping(source_cte: str) -> str:
    points = " union all ".join(
        f"select ticker, '{c}' as col, seq, {c} as v from bars" for c in NEGATIVE)
    poly = f"case when len(m) = 3 then {_lagrange(3)} when len(m) = 4 then {_lagrange(4)} end"
    last = "m[len(m)].y"
    return "with recursive " + source_cte.strip() + f""",
pts as materialized ({points}),
step as (
  select ticker, col, cast(0 as bigint) as seq, cast(null as double) as v, cast(null as double) as orig,
         cast([] as struct(x double, y double)[]) as m, false as neg, cast(null as varchar) as method
  from (select distinct ticker, col from pts)
  union all
  select ticker, col, seq, case when neg then new else v end, v,
         case when coalesce(case when neg then new else v end, -1) >= 0
              then list_slice(list_append(m, {_POINT.format(x='seq', y='case when neg then new else v end')}), -4, -1)
              else m end,
         neg, case when not neg then null when len(m) = 0 then 'skipped_no_previous_valid'
           when len(m) < 3 then 'last_valid_value'
           when p >= 0 then 'cubic_spline_backward' else 'last_valid_value_fallback' end
  from (select *, case when len(m) = 0 then null when len(m) < 3 then {last}
                       when p >= 0 then p else {last} end as new
        from (select pts.ticker, pts.col, pts.seq, pts.v, step.m, coalesce(pts.v < 0, false) as neg,
                     {poly.replace('seq', 'pts.seq').replace('m[', 'step.m[').replace('len(m)', 'len(step.m)')} as p
              from step join pts on pts.ticker = step.ticker and pts.col = step.col
                and pts.seq = step.seq + 1))
),
fixes as (select ticker, col, seq, orig, v, method from step where neg)
"""


@query("C3_fill_negatives_market", _stepping(X.BARS) + f"""
select ticker, seq, col as "column", orig as original, {snap_sql("v", 4)} as corrected, method from fixes""")
def negative_repairs(spark, sf):
    df, layout = X.bars(spark, sf)
    out = negative_prices.negative_repairs(df, layout)
    return out.select("ticker", "seq", "column", "original",
                      snap(F.col("corrected"), 4).alias("corrected"), "method")


@query("C3_fill_negatives_market_panel", _stepping(X.BARS) + """
select b.ticker, b.seq, """ + ", ".join(
    f"{snap_sql(f'coalesce(f{i}.v, b.{c})', 4)} as {c}" for i, c in enumerate(NEGATIVE)) + " from bars b " + " ".join(
    f"left join fixes f{i} on f{i}.ticker = b.ticker and f{i}.seq = b.seq and f{i}.col = '{c}'"
    for i, c in enumerate(NEGATIVE)))
def negative_panel(spark, sf):
    df, layout = X.bars(spark, sf)
    panel = Workspace(spark).table(df.select("ticker", "seq", *S.present(df, S.NONNEGATIVE_MARKET)), "panel")
    out = negative_prices.fill_negative_prices(panel, layout)
    return out.select("ticker", "seq", *[snap(F.col(c), 4).alias(c) for c in NEGATIVE])


@query("C4_negative_market_audit", _stepping(X.BARS) + A.audit_select(
    "negative_market_logs", f"(select f.ticker, f.col, f.orig, {snap_sql('f.v', 4)} as v, f.method, m_date from "
    + A.first_per("fixes", "ticker, col", "seq") + " f join bars b on b.ticker = f.ticker and b.seq = f.seq)",
    error_type="'negative_market_value'", date="m_date", column="col", original_value="orig",
    corrected_value="case when method = 'skipped_no_previous_valid' then null else v end",
    method="method"))
def negative_audit(spark, sf):
    df, layout = X.bars(spark, sf)
    repairs = negative_prices.negative_repairs(df, layout)
    out = slim(negative_prices.negative_price_audit(df, repairs))
    return out.withColumn("corrected_value", snap(F.col("corrected_value"), 4))


# -- bar integrity -------------------------------------------------------------------------------------
def _ohlc_sql() -> str:
    out = []
    for a in S.ADJUSTMENTS:
        o, h, l, c, v = (f"m_{x}{a}" for x in ("open", "high", "low", "close", "vwap"))
        top, bottom = f"greatest({o}, {h}, {l}, {c})", f"least({o}, {h}, {l}, {c})"
        out += [o, c, f"case when {h} < {top} then {top} else {h} end as {h}",
                f"case when {l} > {bottom} then {bottom} else {l} end as {l}",
                f"case when {v} < {l} or {v} > {h} then ({o} + {h} + {l} + {c}) / 4.0e0 else {v} end as {v}"]
    return ", ".join(out)


@query("C10_ohlc_integrity", cte(X.BARS) + f"select ticker, m_date, {_ohlc_sql()} from bars")
def ohlc(spark, sf):
    df, _ = X.bars(spark, sf)
    return market.repair_ohlc(df).select("ticker", "m_date", *PRICES)


@query("C11_ohlc_audit", cte(X.BARS) + A.ohlc("bars"))
def ohlc_audit(spark, sf):
    df, _ = X.bars(spark, sf)
    return slim(market.ohlc_audit(df))


# -- splits -----------------------------------------------------------------------------------------------
SPLIT_K = """,
f as (select *, case when s_split_date_numerator is null or s_split_date_denominator is null
    or s_split_date_numerator = 0 or s_split_date_denominator = 0 then 1e0
    else s_split_date_denominator / s_split_date_numerator end as daily from bars),
ks as (select *, exp(sum(ln(daily)) over (partition by ticker order by seq
    rows between unbounded preceding and current row)) as k from f)"""
PAIRS = [(r, a, f"{a} / nullif({r}, 0)", f"{r} * k") for r, a in S.SPLIT_PRICES]
PAIRS.append((*S.SPLIT_VOLUME, f"{S.SPLIT_VOLUME[0]} / nullif({S.SPLIT_VOLUME[1]}, 0)",
              f"{S.SPLIT_VOLUME[0]} / k"))


@query("C19_split_k_expected", cte(X.BARS + SPLIT_K)
       + "select ticker, seq, daily, round(k, 9) as k_expected from ks")
def split_k(spark, sf):
    df, layout = X.bars(spark, sf)
    return market.with_split_k(df, layout).select(
        "ticker", "seq", market.split_factor().alias("daily"),
        F.round("k_expected", 9).alias("k_expected"))


def _split_sql(pairs):
    return ", ".join(
        snap_sql(f"case when abs({implied} - k) > abs(k) * 0.01e0 then {new} else {a} end") + f" as {a}"
        for _, a, implied, new in pairs)


@query("C20_split_price_consistency", cte(X.BARS + SPLIT_K)
       + f"select ticker, seq, {_split_sql(PAIRS[:-1])} from ks")
def split_prices(spark, sf):
    df, layout = X.bars(spark, sf)
    cols = [a for _, a in S.SPLIT_PRICES]
    out = market.repair_splits(df, layout, columns=cols)
    return out.select("ticker", "seq", *[snap(F.col(c)).alias(c) for c in cols])


@query("C21_split_volume_consistency", cte(X.BARS + SPLIT_K)
       + f"select ticker, seq, {_split_sql(PAIRS[-1:])} from ks")
def split_volume(spark, sf):
    df, layout = X.bars(spark, sf)
    _, c = S.SPLIT_VOLUME
    out = market.repair_splits(df, layout, columns=[c])
    return out.select("ticker", "seq", snap(F.col(c)).alias(c))


@query("C22_split_audit", cte(X.BARS + SPLIT_K) + A.audit_select(
    "split_inconsistencies_logs", A.first_per("(" + " union all ".join(
        f"select ticker, seq, m_date, {i} as rk, '{r}/{a}' as col, {a} as old, {snap_sql(new)} as new, "
        f"{snap_sql(f'abs({implied} - k)')} as dev, '{'volume' if r == 'm_volume' else 'price'}_split_mismatch' as err "
        f"from ks where abs({implied} - k) > abs(k) * 0.01e0"
        for i, (r, a, implied, new) in enumerate(PAIRS)) + ")", "ticker", "seq, rk"),
    error_type="err", date="m_date", column="col", original_value="old", corrected_value="new",
    severity="dev", threshold="0.01e0", method="'recalculated_from_k_expected'"))
def split_audit(spark, sf):
    df, layout = X.bars(spark, sf)
    out = slim(market.split_audit(df, layout))
    return out.withColumn("corrected_value", snap(F.col("corrected_value"))).withColumn(
        "severity", snap(F.col("severity")))


@query("C23_split_skipped_info", "with t as (select distinct l_suppkey as ticker from lineitem) "
       + A.audit_select(
           "split_inconsistencies_logs",
           "(select ticker, unnest(['m_vwap, m_vwap_split_adjusted', 'm_volume_split_adjusted']) as col from t)",
           error_type="'skipped_pair'", filter_type="'info'", column="col",
           method="'missing_columns'"))
def split_skipped(spark, sf):
    df, _ = X.bars(spark, sf)
    return slim(market.split_skipped(
        df.drop("m_vwap", "m_vwap_split_adjusted", "m_volume_split_adjusted")))


# -- column calculations ---------------------------------------------------------------------------------
def _nonneg(c):
    return f"case when {c} >= 0 then {c} end"


def _market_sql(kind: str, a: str) -> str:
    """Calculation of one kind over forward-filled inputs, in SQL."""
    names = {"open": ["open"], "close": ["close"], "volume": ["volume"],
             "vwap": ["open", "high", "low", "close", "vwap"]}.get(
        kind, ["open", "high", "low", "close"])
    fills = ", ".join(_ffill(_nonneg(f"m_{n}{a}"), f"f_{n}") for n in names)
    top, bottom = "greatest(f_open, f_high, f_low, f_close)", "least(f_open, f_high, f_low, f_close)"
    expr = {
        "high": f"case when f_high < {top} then {top} else f_high end",
        "low": f"case when f_low > {bottom} then {bottom} else f_low end",
        "vwap": f"case when f_vwap < {bottom} or f_vwap > {top} "
                f"then (f_open + {top} + {bottom} + f_close) / 4.0e0 else f_vwap end",
    }.get(kind, f"f_{kind}")
    return (cte(X.BARS, f"filled as (select ticker, seq, {fills} from bars)")
            + f"select ticker, seq, {expr} as c_fixed_{kind}{a} from filled")


def _calculation(key: str, name: str, source, sql: str):
    @query(key, sql)
    def run(spark, sf):
        df, layout = source(spark, sf)
        return with_calculations(df, [CALCULATIONS[name]], layout).select("ticker", "seq", name)
    return run


for _i, _kind in enumerate(("high", "low", "vwap", "open", "close", "volume"), 1):
    for _a in S.ADJUSTMENTS:
        _name = f"c_fixed_{_kind}{_a}"
        _calculation(f"D{_i}_{_name}", _name, X.bars, _market_sql(_kind, _a))

for _d, _side in ((7, "assets"), (8, "liabilities")):
    _t, _c, _n = A.BALANCES[f"{_side}_mismatch"]
    for _p, _x, _rest in (("current", _c, "0e0"), ("noncurrent", _n, _t)):
        _name = f"c_fixed_{_p}_{_side}"
        _calculation(f"D{_d}_{_name}", _name, X.funda, cte(X.FUNDA) + f"""
select ticker, seq, case when abs({_t} - ({_c} + {_n})) > abs({_t}) * 0.05e0
  then case when {_c} + {_n} <> 0 then {_x} * ({_t} / ({_c} + {_n})) else {_rest} end
  else {_x} end as {_name} from funda""")

for _b, _col in (("basic", S.BASIC_SHARES), ("diluted", S.DILUTED_SHARES)):
    _name = f"c_fixed_{_b}_shares"
    _calculation(f"D9_{_name}", _name, X.panel, cte(X.PANEL) + "select ticker, seq, " + _ffill(
        f"case when {_col} = 0 and m_volume > 0 then null else {_col} end", _name) + " from panel")
    _calculation(f"D10_{_name}_scale", f"{_name}_scale", X.panel, cte(
        X.PANEL, f"j as (select ticker, seq, {_col}, lag({_col}) over (partition by ticker order by seq) as p from panel)")
        + "select ticker, seq, " + _ffill(
            f"case when {_col} >= p * 10 and p > 0 then null else {_col} end", f"{_name}_scale")
        + " from j")

_EQ, _AC = A.WARNINGS["equity_mismatch"], A.WARNINGS["accounting_equation_mismatch"]
_calculation("D11_c_data_warning", "c_data_warning", X.funda, cte(X.FUNDA) + "select ticker, seq, " + " or ".join(
    f"coalesce(abs({t} - {p}) > abs({t}) * 0.05e0, false)" for _, t, p in (_EQ, _AC))
    + " as c_data_warning from funda")
_calculation("D12_c_test", "c_test", X.bars,
             cte(X.BARS) + "select ticker, seq, m_close - m_open as c_test from bars")


@query("D0_ffill_nonneg", cte(X.BARS) + "select ticker, seq, "
       + _ffill(_nonneg("m_volume"), "m_volume") + " from bars")
def ffill_nonneg(spark, sf):
    df, layout = X.bars(spark, sf)
    return layout.last_valid(df, {"m_volume": F.when(F.col("m_volume") >= 0, F.col("m_volume"))}
                             ).select("ticker", "seq", "m_volume")


# user functions: the second reads the first and a ready-made calculation
def c_spread(m_high, m_low):
    return m_high - m_low


def c_spread_share(c_spread, c_fixed_close):
    return F.try_divide(c_spread, c_fixed_close)


@query("H1_with_calculations", cte(
    X.BARS, "filled as (select *, " + _ffill(_nonneg("m_close"), "c_fixed_close") + " from bars)") + """
select ticker, seq, c_fixed_close, m_high - m_low as c_spread,
  (m_high - m_low) / nullif(c_fixed_close, 0) as c_spread_share from filled""")
def user_calculations(spark, sf):
    df, layout = X.bars(spark, sf)
    out = with_calculations(
        df, [c_spread_share, c_spread, CALCULATIONS["c_fixed_close"]], layout)
    return out.select("ticker", "seq", "c_fixed_close", "c_spread", "c_spread_share")
