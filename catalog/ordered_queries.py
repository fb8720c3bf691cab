"""Queries for date keys, ordering, statement repairs and statement identities."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import audit_sql as A
from catalog import fixtures as X
from catalog.registry import cte, query
from panelmend import schema as S
from panelmend.functions import dates as D
from panelmend.functions import identities as I
from panelmend.layout import with_seq
from panelmend.operators import ordering, statement_repairs, statements

AUDIT = list(A.FIELDS)
BASIC, DILUTED = S.BASIC_SHARES, S.DILUTED_SHARES


def slim(audit):
    """The audit fields both engines print alike."""
    return audit.select(*AUDIT)


# -- dates and order ----------------------------------------------------------------------------
@query("A2_parse_dates", cte(X.DATES) + """
select ticker, pos, cast(coalesce(try_strptime(f_filing_date, '%m/%d/%Y'),
  try_strptime(f_filing_date, '%Y-%m-%d'), try_strptime(f_filing_date, '%d/%m/%Y')) as date) as filed
from dates""")
def parse_dates(spark, sf):
    df, _ = X.dates(spark, sf)
    return df.select("ticker", "pos", D.parse_date("f_filing_date").alias("filed"))


@query("B1_quarter_label", cte(X.DATES) + """
select year(m_date) || '-Q' || quarter(m_date) as quarter, count(*) as n from dates group by 1""")
def quarter_label(spark, sf):
    df = X.table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("m_date"))
    return df.groupBy(D.quarter_label("m_date").alias("quarter")).agg(F.count(F.lit(1)).alias("n"))


@query("B2_quarter_id", """
select o_custkey as ticker, cast(year(o_orderdate) * 10 + quarter(o_orderdate) as bigint) as quarter_id,
  count(*) as n from orders group by 1, 2""")
def quarter_id(spark, sf):
    df = X.table(spark, sf, "orders")
    return df.groupBy(F.col("o_custkey").alias("ticker"),
                      D.quarter_id("o_orderdate").alias("quarter_id")).agg(
        F.count(F.lit(1)).alias("n"))


def _sorted_dates(spark, sf):
    df, longest = X.dates(spark, sf)
    return ordering.sort_dates(df, longest=longest)


@query("B3_sort_dates", cte(X.DATES) + "select ticker, pos, m_date, seq from sorted_dates")
def sort_dates(spark, sf):
    return _sorted_dates(spark, sf).select("ticker", "pos", "m_date", "seq")


@query("B4_order_mismatch_audit", cte(X.DATES) + A.audit_select(
    "unsorted_dates_logs", A.first_per(
        "(select * from sorted_dates where ingest_pos <> seq - 1 and m_date is not null)",
        "ticker", "seq", 100),
    error_type="'order_mismatch'", date="m_date", column="'m_date/f_filing_date'",
    original_value="ingest_pos", corrected_value="seq - 1"))
def order_mismatch(spark, sf):
    return slim(ordering.order_mismatch_audit(_sorted_dates(spark, sf)))


_DEDUPE = cte(X.DATES) + """
select ticker, m_date, pos, f_filing_date from (
  select *, row_number() over (partition by ticker, m_date order by
    cast(try_strptime(f_filing_date, '%m/%d/%Y') as date) {} nulls last, ingest_pos) as rn
  from dates) where rn = 1"""


@query("B5_dedupe_earliest", _DEDUPE.format("asc"))
def dedupe_earliest(spark, sf):
    df, _ = X.dates(spark, sf)
    return ordering.dedupe_dates(df, "earliest").select("ticker", "m_date", "pos", "f_filing_date")


@query("B5_dedupe_latest", _DEDUPE.format("desc"))
def dedupe_latest(spark, sf):
    df, _ = X.dates(spark, sf)
    return ordering.dedupe_dates(df, "latest").select("ticker", "m_date", "pos", "f_filing_date")


@query("B5_dedupe_audit", "with t as (select distinct o_custkey as ticker from orders) "
       + A.audit_select("unsorted_dates_logs", "t", error_type="'duplicates_removed'",
                        column="'m_date'", method="'latest'"))
def dedupe_audit(spark, sf):
    df = X.table(spark, sf, "orders").select(F.col("o_custkey").alias("ticker"))
    return slim(ordering.dedupe_audit(df, "latest"))


@query("B6_no_date_columns", "with t as (select distinct o_custkey as ticker from orders) "
       + A.audit_select("unsorted_dates_logs", "t", error_type="'no_date_columns'"))
def no_date_columns(spark, sf):
    df = X.table(spark, sf, "orders").select(F.col("o_custkey").alias("ticker"), "o_totalprice")
    return slim(ordering.no_date_columns(df))


# -- statement repairs --------------------------------------------------------------------------------
NEGATIVE = [c for c in S.NONNEGATIVE_STATEMENT if f" as {c}" in X.FUNDA]


def _ffill(expr, alias):
    return (f"last_value({expr} ignore nulls) over (partition by ticker order by seq "
            f"rows between unbounded preceding and current row) as {alias}")


@query("C1_fill_negatives_fundamentals", cte(X.FUNDA) + "select ticker, quarter_id, " + ", ".join(
    _ffill(f"case when {c} >= 0 then {c} end", c) for c in NEGATIVE) + " from funda")
def fill_negative_statements(spark, sf):
    df, layout = X.funda(spark, sf)
    out = statement_repairs.fill_negative_statements(df, layout)
    return out.select("ticker", "quarter_id", *NEGATIVE)


@query("C2_negative_fundamentals_audit", cte(X.FUNDA) + A.negative_statements("funda", NEGATIVE))
def negative_statement_audit(spark, sf):
    df, _ = X.funda(spark, sf)
    return slim(statement_repairs.negative_statement_audit(df))


@query("C5_zero_wipeout", cte(X.PANEL) + "select ticker, seq, " + ", ".join(
    _ffill(f"case when {c} = 0 and m_volume > 0 then null else {c} end", c)
    for c in (BASIC, DILUTED)) + " from panel")
def zero_shares(spark, sf):
    df, layout = X.panel(spark, sf)
    return statement_repairs.fill_zero_shares(df, layout).select("ticker", "seq", BASIC, DILUTED)


@query("C6_zero_wipeout_audit", cte(X.PANEL) + A.zero_shares("panel", [BASIC, DILUTED]))
def zero_shares_audit(spark, sf):
    df, _ = X.panel(spark, sf)
    return slim(statement_repairs.zero_shares_audit(df))


def _jump_sql(columns, both=False):
    lags = ", ".join(f"lag({c}) over (partition by ticker order by seq) as p{i}"
                     for i, c in enumerate(columns))
    if both:
        hit = " and ".join(f"{c} >= p{i} * 10" for i, c in enumerate(columns))
        body = _ffill(f"case when {hit} then null else {columns[-1]} end", columns[-1])
    else:
        body = ", ".join(_ffill(f"case when {c} >= p{i} * 10 then null else {c} end", c)
                         for i, c in enumerate(columns))
    return (cte(X.PANEL, f"j as (select ticker, seq, {', '.join(columns)}, {lags} from panel)")
            + f"select ticker, seq, {body} from j")


@query("C7_scale_jump_10x", _jump_sql([BASIC, "c_market_cap"]))
def scale_jump(spark, sf):
    df, layout = X.panel(spark, sf)
    return statement_repairs.fill_jumps(df, layout).select("ticker", "seq", BASIC, "c_market_cap")


@query("C8_scale_jump_correlated", _jump_sql(["c_market_cap", DILUTED], both=True))
def scale_jump_correlated(spark, sf):
    df, layout = X.panel(spark, sf)
    return statement_repairs.fill_correlated_jumps(df, layout).select("ticker", "seq", DILUTED)


@query("C9_scale_jump_audit", cte(X.PANEL) + A.jumps("panel", [BASIC, "c_market_cap"]))
def scale_jump_audit(spark, sf):
    df, layout = X.panel(spark, sf)
    return slim(statement_repairs.jump_audit(df, layout))


# -- identities ------------------------------------------------------------------------------------------
def _balance_sql():
    out = []
    for t, c, n in A.BALANCES.values():
        bad = f"abs({t} - ({c} + {n})) > abs({t}) * 0.05e0"
        out.append(f"case when {bad} then case when {c} + {n} <> 0 then {c} * ({t} / ({c} + {n})) "
                   f"else 0e0 end else {c} end as {c}")
        out.append(f"case when {bad} then case when {c} + {n} <> 0 then {n} * ({t} / ({c} + {n})) "
                   f"else {t} end else {n} end as {n}")
    return ", ".join(out)


PARTS = [c for _, *cs in A.BALANCES.values() for c in cs]


@query("C12_balance_identity_repair", cte(X.FUNDA)
       + f"select ticker, quarter_id, {_balance_sql()} from funda")
def balance_repair(spark, sf):
    df, _ = X.funda(spark, sf)
    return statements.repair_balances(df).select("ticker", "quarter_id", *PARTS)


@query("C13_balance_identity_audit", cte(X.FUNDA) + A.balances("funda"))
def balance_audit(spark, sf):
    df, _ = X.funda(spark, sf)
    return slim(statements.balance_audit(df))


def _flag_query(name, error, flag):
    _, t, p = A.WARNINGS[error]

    @query(name, cte(X.FUNDA) + f"select ticker, quarter_id, abs({t} - {p}) > abs({t}) * 0.05e0 "
           "as mismatch from funda")
    def run(spark, sf):
        df, _ = X.funda(spark, sf)
        return df.select("ticker", "quarter_id", flag().alias("mismatch"))
    return run


_flag_query("C14_equity_mismatch", "equity_mismatch", I.equity_mismatch)
_flag_query("C15_cash_mismatch", "cash_mismatch", I.cash_mismatch)
_flag_query("C16_accounting_equation_mismatch", "accounting_equation_mismatch",
            I.accounting_equation_mismatch)


@query("C17_data_warning", cte(X.FUNDA) + "select ticker, quarter_id, " + " or ".join(
    f"(abs({t} - {p}) > abs({t}) * 0.05e0)" for _, t, p in A.WARNINGS.values())
    + " as data_warning from funda")
def data_warning(spark, sf):
    df, _ = X.funda(spark, sf)
    fixed = statements.repair_balances(df)
    return statements.add_data_warning(fixed).select("ticker", "quarter_id", "data_warning")


@query("C18_soft_warning_audit", cte(X.FUNDA) + A.warnings("funda"))
def warning_audit(spark, sf):
    df, _ = X.funda(spark, sf)
    return slim(statements.warning_audit(df))
