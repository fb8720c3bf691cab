"""Queries for the audit trail, the vendor log, files and whole cleaning runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import audit_sql as A
from catalog import fixtures as X
from catalog.ordered_queries import NEGATIVE, slim
from catalog.outlier_queries import MODEL, universe
from catalog.registry import cte, query
from panelmend.operators import (
    audit_review, market, rolling_z, statement_repairs, statements,
)
from panelmend.plans import pipeline, rules
from panelmend.sources import panel_files, vendor_log
from panelmend.workspace import Workspace


# -- the audit trail under review -------------------------------------------------------------------
def audit(spark, sf):
    """Audit rows of four rules."""
    bars, _ = X.bars(spark, sf)
    funda, _ = X.funda(spark, sf)
    return audit_review.audit_union(
        statement_repairs.negative_statement_audit(funda), market.ohlc_audit(bars),
        statements.balance_audit(funda), statements.warning_audit(funda))


AUDIT = X.BARS + "," + X.FUNDA + ", audit as (" + " union all ".join(
    [A.negative_statements("funda", NEGATIVE), A.ohlc("bars"), A.balances("funda"),
     A.warnings("funda")]) + ")"
LOGS = AUDIT + """, logs as (
  select ticker, coalesce(strftime(coalesce("date", date_start), '%Y-%m-%d'), '') as "date",
    category as error_category, error_type, coalesce("column", '') as column_involved, filter_type
  from audit)"""
LOG_COLUMNS = ["ticker", "date", "error_category", "error_type", "column_involved", "filter_type"]


def logs(spark, sf):
    return audit_review.normalize_audit(audit(spark, sf))


_CAP = 6


@query("F1_cap_audit_per_ticker", cte(AUDIT) + f"""
, keyed as (select *, case when rule = 'financial_unequivalencies_logs' then filter_type
    when rule = 'negative_fundamentals_logs' then "column" else '' end as share from audit),
ranked as (select *, row_number() over (partition by ticker, rule, share order by
    coalesce("date", date_start) nulls last, error_type, "column", original_value nulls first,
    corrected_value nulls first) as rn,
    count(*) over (partition by ticker, rule, share) as n_key,
    count(*) over (partition by ticker, rule) as n_all from keyed)
select {', '.join(f'"{c}"' for c in A.FIELDS)} from ranked where rn <= case
  when rule = 'financial_unequivalencies_logs' then {_CAP // 2}
  when rule = 'negative_fundamentals_logs' then least({_CAP}, greatest(1, floor({_CAP} * n_key / n_all)))
  else {_CAP} end""")
def cap(spark, sf):
    return slim(audit_review.cap_per_ticker(audit(spark, sf), _CAP))


@query("F2_audit_summary", cte(AUDIT) + """
select rule, key, count(*) as total_logs from (select rule,
  case when rule = 'financial_unequivalencies_logs' then filter_type
    when rule = 'negative_fundamentals_logs' then "column" else 'all' end as key from audit)
group by rollup (rule, key)""")
def summary(spark, sf):
    return audit_review.audit_summary(audit(spark, sf))


@query("F3_audit_union", cte(AUDIT) + "select * from audit")
def union(spark, sf):
    return slim(audit(spark, sf))


@query("F4_normalize_audit", cte(LOGS) + f"select {', '.join(chr(34) + c + chr(34) for c in LOG_COLUMNS)} from logs")
def normalize(spark, sf):
    return logs(spark, sf).select(*LOG_COLUMNS)


@query("F4_normalized_values", cte(AUDIT) + """
select ticker, rule, error_type, "column", coalesce("date", date_start) as "date",
  case when filter_type = 'correction' then original_value end as original_number,
  case when rule = 'ohlc_logs' then corrected_value end as corrected_number,
  case when rule = 'negative_fundamentals_logs' then 'Forward filled'
       when filter_type = 'soft_warning' then 'Not applicable' end as corrected_text,
  severity from audit""")
def normalized_values(spark, sf):
    """Numbers read back out of the text columns and of the JSON copy of the audit row."""
    text = logs(spark, sf)
    number = lambda c: F.expr(f"try_cast({c} as double)")
    raw = F.from_json("raw_log", "rule string, column string, date date, date_start date, severity double")
    return text.withColumn("r", raw).select(
        "ticker", "r.rule", "error_type", F.col("r.column").alias("column"),
        F.coalesce("r.date", "r.date_start").alias("date"),
        number("original_value").alias("original_number"),
        number("corrected_value").alias("corrected_number"),
        F.when(F.col("corrected_value").isin("Forward filled", "Not applicable"),
               F.col("corrected_value")).alias("corrected_text"), "r.severity")


@query("F4_messages")
def messages(spark, sf):
    return logs(spark, sf).select("ticker", "date", "error_type", "message", "original_value",
                                  "corrected_value", "raw_log")


@query("F5_audit_tickers", cte(AUDIT) + "select distinct ticker from audit")
def tickers(spark, sf):
    return audit_review.audit_tickers(audit(spark, sf))


@query("F6_audit_facets", cte(LOGS) + " union all ".join(
    f"""select '{facet}' as facet, value from (select distinct "{c}" as value from logs
    where "{c}" <> '')"""
    for facet, c in (("date", "date"), ("column", "column_involved"), ("type", "error_type"))))
def facets(spark, sf):
    return audit_review.audit_facets(logs(spark, sf))


_SEARCH = """ from logs where error_category = 'Accounting Mismatch' and filter_type = 'hard_error'
  and error_type = 'assets_mismatch'"""
_SEARCH_ARGS = {"category": "Accounting Mismatch", "filter_type": "hard_error",
                "types": ["assets_mismatch"]}


@query("F7_audit_search", cte(LOGS) + f"""select {', '.join(chr(34) + c + chr(34) for c in LOG_COLUMNS)}
{_SEARCH}""")
def search(spark, sf):
    return audit_review.audit_search(logs(spark, sf), **_SEARCH_ARGS).select(*LOG_COLUMNS)


@query("F7_audit_match_count", cte(LOGS) + f"select count(*) as match_count {_SEARCH}")
def match_count(spark, sf):
    return audit_review.audit_match_count(logs(spark, sf), **_SEARCH_ARGS)


def _flags(text):
    return text.where("cast(ticker as bigint) % 7 = 0").select(*audit_review.KEY).distinct().withColumn(
        "flagged_at", F.lit("2024-01-01").cast("date"))


_FLAGS = """, flags as (select distinct ticker, "date", error_type, column_involved,
  date '2024-01-01' as flagged_at from logs where cast(ticker as bigint) % 7 = 0)"""
_TOGGLES = """, toggles as (
  select ticker, "date", error_type, column_involved, date '2024-02-01' as toggled_at from logs
    where cast(ticker as bigint) % 5 = 0
  union all
  select ticker, "date", error_type, column_involved, date '2024-03-01' from logs
    where cast(ticker as bigint) % 25 = 0)"""
_K = "ticker, \"date\", error_type, column_involved"


@query("F8_flag_false_positives", cte(LOGS + _FLAGS) + f"""
select l.*, f.ticker is not null as is_false_positive from logs l left join flags f
  using ({_K})""")
def flag(spark, sf):
    text = logs(spark, sf)
    return audit_review.mark_false_positives(text, _flags(text)).select(
        *LOG_COLUMNS, "is_false_positive")


@query("F9_toggle_false_positives", cte(LOGS + _FLAGS + _TOGGLES) + f"""
, flips as (select {_K}, count(*) as n, max(toggled_at) as last_at from toggles group by all)
select {_K}, case when f.flagged_at is not null then f.flagged_at else last_at end as flagged_at
from flags f full join flips t using ({_K})
where (f.flagged_at is not null) <> (coalesce(n, 0) % 2 = 1)""")
def toggle(spark, sf):
    text = logs(spark, sf)
    keys = text.select(*audit_review.KEY)
    number = F.col("ticker").cast("bigint")
    toggles = keys.where(number % 5 == 0).withColumn("toggled_at", F.lit("2024-02-01").cast("date")).unionByName(
        keys.where(number % 25 == 0).withColumn("toggled_at", F.lit("2024-03-01").cast("date")))
    return audit_review.toggle_false_positives(_flags(text), toggles)


@query("F10_drop_soft_warnings", cte(LOGS) + """
select error_category, filter_type, count(*) as n from logs where filter_type <> 'soft_warning' group by all""")
def drop_soft(spark, sf):
    return audit_review.drop_soft_warnings(logs(spark, sf)).groupBy(
        "error_category", "filter_type").agg(F.count(F.lit(1)).alias("n"))


@query("F11_before_after", cte(X.BARS) + """
select ticker, seq, m_date, m_vwap as original, (m_open + m_high + m_low + m_close) / 4.0e0 as cleaned
from bars where (m_vwap < m_low or m_vwap > m_high)
  and (m_open + m_high + m_low + m_close) / 4.0e0 <> m_vwap""")
def before_after(spark, sf):
    df, _ = X.bars(spark, sf)
    return audit_review.before_after(df, market.repair_ohlc(df), "m_vwap")


@query("F12_error_context_window", cte(X.BARS) + """
, b as materialized (select ticker, seq, m_date, m_close from bars),
e as materialized (select ticker, m_date as error_date, unnest(range(seq - 30, seq + 31)) as seq
  from b where m_close < 0)
select e.ticker, e.error_date, b.seq, b.m_date, b.m_close as value
from e join b on b.ticker = e.ticker and b.seq = e.seq""")
def context(spark, sf):
    df, _ = X.bars(spark, sf)
    errors = df.where("m_close < 0").select("ticker", "m_date")
    return audit_review.error_context(df, errors, "m_close")


@query("F13_error_dates_for_column", cte(LOGS) + """
, named as (select ticker, "date", contains(column_involved, 'fbs_liabilities') as hit,
  bool_or(contains(column_involved, 'fbs_liabilities')) over (partition by ticker) as anyhit from logs)
select distinct ticker, "date" from named where (hit or not anyhit) and "date" <> ''""")
def error_dates(spark, sf):
    return audit_review.error_dates(logs(spark, sf), "fbs_liabilities")


@query("F14_accounting_equation_series", cte(X.FUNDA) + """
select ticker, seq, m_date, fbs_assets as assets, coalesce(fbs_liabilities, 0) +
  coalesce(fbs_stockholder_equity, 0) + coalesce(fbs_noncontrolling_interest, 0) as claims from funda""")
def accounting(spark, sf):
    df, _ = X.funda(spark, sf)
    return audit_review.accounting_series(df)


# -- vendor log -----------------------------------------------------------------------------------------
_PARSED = """with p as (select event_id, 'U' || user_id as ticker, event_id % 6 as k from events
  where event_type = 'error'),
parsed as (select event_id, ticker, case k
  when 0 then 'FundamentalData.rows are not correctly sorted by date'
  when 1 then 'Negative FundamentalDataRowIncome.weighted_average_diluted_shares_outstanding detected'
  when 2 then 'No data returned by unadjusted market data endpoint'
  when 3 then 'MarketDataDailyRow low > high for date 2023-07-07'
  when 4 then 'Negative MarketDataDailyRow.low for date 1993-06-01'
  else 'Unknown failure' end as message, case k
  when 0 then 'FundamentalData rows not sorted by date' when 1 then 'Negative shares outstanding'
  when 2 then 'No unadjusted market data' when 3 then 'Market data low > high'
  when 4 then 'Negative price value' else 'Unknown failure' end as category from p)
"""


@query("F15_raw_log_parse", _PARSED + "select * from parsed")
def parse_log(spark, sf):
    return vendor_log.parse_vendor_log(X.vendor_log(spark, sf)).select(
        "event_id", "ticker", "message", "category")


@query("F16_raw_log_summary", _PARSED + """
select category, cast(sum(count(*)) over (partition by category) as bigint) as category_count,
  ticker, count(*) as entries from parsed group by category, ticker""")
def log_summary(spark, sf):
    return vendor_log.summarise_vendor_log(vendor_log.parse_vendor_log(X.vendor_log(spark, sf)))


# -- files ------------------------------------------------------------------------------------------------
FILE_COLUMNS = ["m_date", "m_open", "m_high", "m_low", "m_close", "m_volume"]


def _file_panel(spark, sf):
    df, _ = X.bars(spark, sf)
    return df.select(F.col("ticker").cast("string").alias("ticker"), "seq", *FILE_COLUMNS)


@query("A1_read_panel_csv", cte(X.BARS) + """
select cast(ticker as varchar) as ticker, m_date, m_open, m_high, m_low, m_close,
  case when ticker % 2 = 0 then m_volume end as m_volume, seq - 1 as ingest_pos from bars""")
def read_panel(spark, sf):
    """Ticker files with two different headers, written and read back."""
    df = _file_panel(spark, sf).withColumn("even", F.col("ticker").cast("bigint") % 2 == 0)
    root = Workspace(spark).root
    panel_files.write_panel(df.where("even").drop("even"), f"{root}/in", "csv")
    other = df.where("not even").select("ticker", "m_close", "m_low", "m_open", "m_high", "m_date", "seq")
    # other column order and no volume
    panel_files.write_tickers(other.repartition("ticker").sortWithinPartitions("ticker", "seq"),
                              f"{root}/in", "csv", "append")
    out = panel_files.read_panel(spark, f"{root}/in", "ticker=*/*.csv")
    return out.select("ticker", *FILE_COLUMNS, "ingest_pos")


@query("A3_read_universe", """
select cast(s_suppkey as varchar) as symbol, s_acctbal as price, 'S' || (s_nationkey % 5) as sector,
  date '2000-01-01' + cast(s_suppkey as int) as "ipoDate", s_nationkey % 2 = 0 as "isEtf" from supplier""")
def read_universe(spark, sf):
    raw = X.table(spark, sf, "supplier").selectExpr(
        "cast(s_suppkey as string) symbol", "s_acctbal price",
        "concat('S', cast(s_nationkey % 5 as string)) sector",
        "date_add(date'2000-01-01', cast(s_suppkey as int)) ipoDate", "s_nationkey % 2 = 0 isEtf")
    path = f"{Workspace(spark).root}/universe"
    # one metadata file, as it comes: one row per symbol
    raw.coalesce(1).write.option("header", True).csv(path)
    file = panel_files._list_files(spark, path, "*.csv")[0]
    return panel_files.read_universe(spark, file)


@query("A4_read_corrected_panel", cte(X.BARS) + """
select cast(ticker as varchar) as ticker, seq, m_date, m_open, greatest(m_open, m_high, m_low, m_close) as m_high,
  least(m_open, m_high, m_low, m_close) as m_low, m_close, m_volume from bars""")
def read_corrected(spark, sf):
    df = market.repair_ohlc(_file_panel(spark, sf))
    path = f"{Workspace(spark).root}/corrected"
    panel_files.write_panel(df, path, "csv")
    return panel_files.read_written(spark, path, "csv", df.schema)


@query("A4_pair_with_raw", "select 't' || l_suppkey as ticker, case when l_suppkey % 3 = 0 then 'T' else 't' end || "
       "l_suppkey as raw_ticker from lineitem group by l_suppkey")
def pair_with_raw(spark, sf):
    keys = X.table(spark, sf, "lineitem").select(F.col("l_suppkey").cast("string").alias("k"))
    clean = keys.select(F.concat(F.lit("t"), "k").alias("ticker"))
    third = F.col("k").cast("bigint") % 3 == 0
    raw = keys.select(F.concat(F.when(third, "T").otherwise("t"), F.col("k")).alias("ticker"))
    return panel_files.pair_with_raw(clean, raw)


@query("A5_read_audit", cte(AUDIT) + "select * from audit")
def read_audit(spark, sf):
    root = Workspace(spark).root
    panel_files.write_audit(audit(spark, sf), f"{root}/logs")
    return slim(panel_files.read_audit(spark, f"{root}/logs", f"{root}/missing"))


@query("A6_write_panel", cte(X.BARS) + """
select cast(ticker as varchar) as ticker, seq, m_date, m_open, m_high, m_low,
  case when ticker % 2 = 0 then m_close else 0 end as m_close, m_volume from bars""")
def write_panel(spark, sf):
    """Even tickers are saved first; a second save without overwriting adds the others."""
    df = _file_panel(spark, sf)
    path = f"{Workspace(spark).root}/saved"
    panel_files.write_panel(df.where(F.col("ticker").cast("bigint") % 2 == 0), path, "parquet")
    panel_files.write_panel(df.withColumn("m_close", F.lit(0.0)), path, "parquet", overwrite=False)
    return panel_files.read_written(spark, path, "parquet", df.schema)


@query("A7_write_panel_formats", cte(X.BARS) + "".join(f"""
{'union all' if i else ''} select '{f}' as format, cast(ticker as varchar) as ticker, count(*) as n,
  max(seq) as last_seq, max(m_high) as top from bars group by ticker""" for i, f in enumerate(("csv", "parquet"))))
def write_formats(spark, sf):
    df = _file_panel(spark, sf)
    root = f"{Workspace(spark).root}/both"
    panel_files.write_panel_formats(df, root)
    parts = [panel_files.read_written(spark, f"{root}/{f}", f, df.schema).groupBy("ticker").agg(
        F.count(F.lit(1)).alias("n"), F.max("seq").alias("last_seq"), F.max("m_high").alias("top"))
        .withColumn("format", F.lit(f)) for f in ("csv", "parquet")]
    return parts[0].unionByName(parts[1])


@query("A8_write_audit", cte(AUDIT) + """
select stage, rule, filter_type, count(*) as n, sum("count") as rows_touched from audit group by all""")
def write_audit(spark, sf):
    path = f"{Workspace(spark).root}/logs"
    panel_files.write_audit(audit(spark, sf), path)
    return panel_files.read_audit(spark, path).groupBy("stage", "rule", "filter_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum("count").alias("rows_touched"))


# -- cleaning runs -------------------------------------------------------------------------------------------
def _ingested(spark, sf):
    """The panel as it arrives: positions instead of ``seq``."""
    df, _ = X.panel(spark, sf)
    return df.withColumn("ingest_pos", F.col("seq") - 1).drop("seq", "sector", "quarter_id")


def _counts(result):
    return result.audit.groupBy("rule", "error_type", "filter_type").agg(F.count(F.lit(1)).alias("n"))


STAT_RULES = (
    rules.Rule("rolling_z", rules._rolling_z, cut=True),
    rules.Rule("sector", rules._sector, {"columns": MODEL}, cut=True),
    rules.Rule("mad", rules._mad, cut=True),
    rules.Rule("garch", rules._garch, {"columns": ["m_open"]}, cut=True),
)


@query("H2_rule_protocol", cte(X.PANEL, "a as (" + " union all ".join(
    [A.negative_statements("panel", NEGATIVE), A.ohlc("panel"), A.balances("panel"),
     A.warnings("panel")]) + ")") + """
select rule, error_type, filter_type, count(*) as n from a group by all""")
def rule_protocol(spark, sf):
    """A run with a hand-picked list of rules."""
    chosen = [r for r in rules.SANITY if r.name in ("negative_statements", "ohlc", "statements")]
    return _counts(pipeline.run_sanity_checks(_ingested(spark, sf), rules=chosen))


@query("G1_run_sanity_checks")
def sanity(spark, sf):
    return _counts(pipeline.run_sanity_checks(_ingested(spark, sf)))


@query("G2_run_statistical_filters")
def statistical(spark, sf):
    df, layout = X.panel(spark, sf)
    return _counts(pipeline.run_statistical_filters(
        df, universe(spark, sf), rules=STAT_RULES, layout=layout))


@query("G3_run_full_pipeline")
def full(spark, sf):
    root = Workspace(spark).root
    result = pipeline.run_full_pipeline(_ingested(spark, sf), universe(spark, sf), root,
                                        statistical=STAT_RULES)
    return _counts(result)


@query("G4_load_or_run", cte(X.BARS) + """
select cast(ticker as varchar) as ticker, count(*) as n, max(seq) as last_seq, true as reused
from bars group by ticker""")
def load_or_run(spark, sf):
    """The second call finds the first one's files."""
    root = Workspace(spark).root
    columns = ["ticker", "ingest_pos", "m_date", "m_open", "m_high", "m_low", "m_close", "m_vwap"]
    chosen = [r for r in rules.SANITY if r.name == "ohlc"]
    result = None
    for _ in range(2):
        result = pipeline.load_or_run(
            spark, root, lambda: _ingested(spark, sf).select(*columns), sanity=chosen, statistical=())
    return result.panel.groupBy("ticker").agg(
        F.count(F.lit(1)).alias("n"), F.max("seq").alias("last_seq"),
        F.lit(result.reused).alias("reused"))
