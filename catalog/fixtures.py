"""Test inputs derived from the driver tables, in Spark and (for checking) in DuckDB SQL.

The Spark side is built with the library's own ordered primitives, so a supplier holding a
large share of all rows is handled here as anywhere else. The only thing remembered between
queries is how long the longest ticker of a source table is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelmend.layout import Layout, longest_key, with_seq

_sizes: dict = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def longest_of(spark: SparkSession, sf_dir: str, name: str, rows: DataFrame) -> int:
    """Rows of a source's longest ticker, looked up once.

    ``rows`` has at least as many rows per ticker as the fixture made from it.
    """
    known = (spark.sparkContext.applicationId, sf_dir, name)
    if known not in _sizes:
        _sizes[known] = longest_key(rows, "ticker")
    return _sizes[known]


# -- bars ------------------------------------------------------------------------------------------
def _bar_rows(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("ticker"), F.to_date("l_shipdate").alias("m_date"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("p"),
        F.col("l_quantity").alias("q"), F.col("l_extendedprice").alias("x"),
        ((F.col("l_orderkey") * 10 + F.col("l_linenumber")) * 100000 + F.col("l_partkey")).alias("k"))


def bars(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, Layout]:
    """Daily bars with planted errors, and their layout."""
    base = _bar_rows(spark, sf_dir)
    longest = longest_of(spark, sf_dir, "lineitem", base)
    layout = Layout(longest=longest)
    if not layout.blocked:
        base = base.repartition("ticker")  # days, positions and sums share this one exchange
    money = F.sum(F.col("x").cast("decimal(18,2)")).cast("double")
    g = base.groupBy("ticker", "m_date").agg(
        F.min_by("p", "k").alias("o"), F.max("p").alias("h"), F.min("p").alias("l"),
        F.max_by("p", "k").alias("c"), F.sum("q").alias("v"), (money / F.sum("q")).alias("w"))
    g = g.withColumn("z", F.expr(
        "(ticker * 31 + year(m_date) * 372 + month(m_date) * 31 + day(m_date)) % 101"))
    g = with_seq(g, ["m_date"], longest=longest)
    g = layout.running_sum(g, {"n": F.when(F.col("z") == 5, 1.0)})
    g = g.withColumn("kx", F.pow(F.lit(0.5), "n"))
    g = g.selectExpr(
        "ticker", "m_date", "cast(year(m_date) * 10 + quarter(m_date) as bigint) quarter_id",
        "seq", "kx", "z", "o m_open", "case when z = 1 then l * 0.5D else h end m_high", "l m_low",
        "case when z = 0 then -c when z = 4 then c * 32 else c end m_close", "c",
        "case when z = 2 then -v when z = 7 then null else v end m_volume", "v",
        "case when z = 3 then h * 2 else w end m_vwap")
    g = g.selectExpr(
        "ticker", "m_date", "quarter_id", "seq", "m_open", "m_high", "m_low", "m_close",
        "m_volume", "m_vwap", "m_open * kx m_open_split_adjusted",
        "m_high * kx m_high_split_adjusted", "m_low * kx m_low_split_adjusted",
        "c * kx * (case when z = 6 then 1.5D else 1.0D end) m_close_split_adjusted",
        "v / kx m_volume_split_adjusted", "m_vwap * kx m_vwap_split_adjusted",
        *[f"m_{n} * kx * 0.75D m_{n}_dividend_and_split_adjusted"
          for n in ("open", "high", "low", "close", "vwap")],
        "m_volume / kx m_volume_dividend_and_split_adjusted",
        "cast(case when z = 5 then 2 end as double) s_split_date_numerator",
        "cast(case when z = 5 then 1 end as double) s_split_date_denominator")
    return g, layout


_ADJ = ",\n       ".join(
    f"m_{n} * kx * 0.75e0 as m_{n}_dividend_and_split_adjusted"
    for n in ("open", "high", "low", "close", "vwap"))
BARS = f"""
bars_base as (
  select l_suppkey as ticker, cast(l_shipdate as date) as m_date,
         l_extendedprice / l_quantity as p, l_quantity as q, l_extendedprice as x,
         (l_orderkey * 10 + l_linenumber) * 100000 + l_partkey as k
  from lineitem),
bars_g as (
  select ticker, m_date, min_by(p, k) as o, max(p) as h, min(p) as l, max_by(p, k) as c,
         sum(q) as v, cast(sum(cast(x as decimal(18,2))) as double) / sum(q) as w,
         (ticker * 31 + year(m_date) * 372 + month(m_date) * 31 + day(m_date)) % 101 as z
  from bars_base group by ticker, m_date),
bars_k as (
  select *, cast(row_number() over (partition by ticker order by m_date) as bigint) as seq,
         power(0.5e0, sum(case when z = 5 then 1 else 0 end) over (partition by ticker
           order by m_date rows between unbounded preceding and current row)) as kx
  from bars_g),
bars_r as (
  select ticker, m_date, cast(year(m_date) * 10 + quarter(m_date) as bigint) as quarter_id, seq,
         kx, z, c, v, o as m_open, case when z = 1 then l * 0.5e0 else h end as m_high, l as m_low,
         case when z = 0 then -c when z = 4 then c * 32 else c end as m_close,
         case when z = 2 then -v when z = 7 then null else v end as m_volume,
         case when z = 3 then h * 2 else w end as m_vwap
  from bars_k),
bars as (
  select ticker, m_date, quarter_id, seq, m_open, m_high, m_low, m_close, m_volume, m_vwap,
       m_open * kx as m_open_split_adjusted, m_high * kx as m_high_split_adjusted,
       m_low * kx as m_low_split_adjusted,
       c * kx * (case when z = 6 then 1.5e0 else 1.0e0 end) as m_close_split_adjusted,
       v / kx as m_volume_split_adjusted, m_vwap * kx as m_vwap_split_adjusted,
       {_ADJ},
       m_volume / kx as m_volume_dividend_and_split_adjusted,
       cast(case when z = 5 then 2 end as double) as s_split_date_numerator,
       cast(case when z = 5 then 1 end as double) as s_split_date_denominator
  from bars_r)"""

# -- funda -----------------------------------------------------------------------------------------
# shared text: valid in both engines
_FUNDA_COLUMNS = """
  ta as fbs_assets,
  case when z = 0 then ca * 2 when z = 1 then 0e0 else ca end as fbs_current_assets,
  case when z = 1 then 0e0 else na end as fbs_noncurrent_assets,
  ta * 0.5e0 as fbs_liabilities, ta * 0.25e0 as fbs_current_liabilities,
  case when z = 2 then ta else ta * 0.25e0 end as fbs_noncurrent_liabilities,
  case when z = 3 then ta else ta * 0.5e0 end as fbs_stockholder_equity,
  ta * 0.125e0 as fbs_common_stock_value, ta * 0.125e0 as fbs_additional_paid_in_capital,
  ta * 0.25e0 as fbs_retained_earnings,
  case when z = 4 then ta * 0.25e0 else 0e0 end as fbs_other_stockholder_equity,
  case when z % 2 = 0 then null else 0e0 end as fbs_noncontrolling_interest,
  case when z = 5 then ca * 0.5e0 else ca end as fcf_period_end_cash,
  ca as fbs_cash_and_cash_equivalents,
  case when z = 6 then -qty when z = 12 then null else qty end as fis_revenues,
  case when z = 7 then 0e0 when z = 8 then n * 1e5 else n * 1e3 end
    as fis_weighted_average_basic_shares_outstanding,
  case when z = 7 then 0e0 when z = 8 then n * 1e5 else n * 1e3 end
    as fis_weighted_average_diluted_shares_outstanding,
  case when z = 8 then ta * 128 else ta end as c_market_cap"""


def _funda_columns() -> list[str]:
    parts = _FUNDA_COLUMNS.replace("\n    as ", " as ").split(",\n")
    flat = [q for p in parts for q in p.split(", ")]
    return [q.strip() for q in flat]


def funda(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, Layout]:
    """Quarterly statements with planted errors. A ticker has one row per calendar quarter."""
    line = table(spark, sf_dir, "lineitem")
    supplier = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("ticker"), (F.col("s_nationkey") % 5).alias("sector"))
    money = lambda c: F.sum(c.cast("decimal(18,2)")).cast("double")
    price, zero = F.col("l_extendedprice"), F.lit(0.0)
    a = line.groupBy(
        F.col("l_suppkey").alias("ticker"),
        F.expr("cast(year(l_shipdate) * 10 + quarter(l_shipdate) as bigint)").alias("quarter_id")
    ).agg(money(price).alias("ta"),
          money(F.when(F.col("l_returnflag") == "A", price).otherwise(zero)).alias("ca"),
          money(F.when(F.col("l_returnflag") != "A", price).otherwise(zero)).alias("na"),
          F.sum("l_quantity").alias("qty"), F.count(F.lit(1)).alias("n"))
    joined = a.join(supplier, "ticker")
    b = joined.withColumn("z", F.expr("(ticker * 7 + quarter_id) % 13"))
    out = with_seq(b.selectExpr(
        "ticker", "cast(sector as bigint) sector", "quarter_id",
        "make_date(cast(quarter_id div 10 as int), cast((quarter_id % 10 - 1) * 3 + 1 as int), 1) "
        "m_date", *_funda_columns()), ["quarter_id"], longest=0)
    return out, Layout(longest=0)


FUNDA = f"""
funda_a as (
  select l_suppkey as ticker, s_nationkey % 5 as sector,
         year(l_shipdate) * 10 + quarter(l_shipdate) as quarter_id,
         cast(sum(cast(l_extendedprice as decimal(18,2))) as double) as ta,
         cast(sum(cast(case when l_returnflag = 'A' then l_extendedprice else 0 end as decimal(18,2))) as double) as ca,
         cast(sum(cast(case when l_returnflag <> 'A' then l_extendedprice else 0 end as decimal(18,2))) as double) as na,
         sum(l_quantity) as qty, count(*) as n
  from lineitem join supplier on l_suppkey = s_suppkey
  group by l_suppkey, s_nationkey % 5, year(l_shipdate) * 10 + quarter(l_shipdate)),
funda_b as (select *, (ticker * 7 + quarter_id) % 13 as z from funda_a),
funda as (
  select ticker, cast(sector as bigint) as sector, cast(quarter_id as bigint) as quarter_id,
  make_date(cast(quarter_id // 10 as int), cast((quarter_id % 10 - 1) * 3 + 1 as int), 1) as m_date,
  {_FUNDA_COLUMNS},
  cast(row_number() over (partition by ticker order by quarter_id) as bigint) as seq
  from funda_b)"""


# -- panel -----------------------------------------------------------------------------------------
def panel(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, Layout]:
    """Daily rows with their quarter's statement values."""
    daily, layout = bars(spark, sf_dir)
    quarterly, _ = funda(spark, sf_dir)
    quarterly = quarterly.drop("m_date", "seq")
    if not layout.blocked:
        quarterly = quarterly.repartition("ticker")  # as the bars are, which then stay where they lie
    return daily.join(quarterly, ["ticker", "quarter_id"], "left"), layout


PANEL = BARS + "," + FUNDA + """,
panel as (
  select bars.*, funda.* exclude (ticker, quarter_id, m_date, seq)
  from bars left join funda on bars.ticker = funda.ticker and bars.quarter_id = funda.quarter_id)"""


# -- series, vendor log, dates ----------------------------------------------------------------------
def series(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, Layout]:
    """Irregular event series with spikes and gaps."""
    e = table(spark, sf_dir, "events").selectExpr(
        "user_id ticker", "event_id", "to_date(ts) m_date", "ts",
        "case when event_id % 97 = 0 then value * 1024 when event_id % 89 = 0 then null "
        "else value end v")
    longest = longest_of(spark, sf_dir, "events", e)
    return with_seq(e, ["ts", "event_id"], longest=longest), Layout(longest=longest)


SERIES = """
series as (
  select user_id as ticker, event_id, ts, cast(ts as date) as m_date,
         cast(row_number() over (partition by user_id order by ts, event_id) as bigint) as seq,
         case when event_id % 97 = 0 then value * 1024
              when event_id % 89 = 0 then null else value end as v
  from events)"""

_LOG_TEXTS = [
    " FundamentalData.rows are not correctly sorted by date",
    " Negative FundamentalDataRowIncome.weighted_average_diluted_shares_outstanding detected",
    " No data returned by unadjusted market data endpoint",
    " MarketDataDailyRow low > high for date 2023-07-07",
    " Negative MarketDataDailyRow.low for date 1993-06-01",
    " Unknown failure",
]
_LOG_HEAD = " skipping output as it presented the following error during data assembly:"


def vendor_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.element_at(F.array(*[F.lit(t) for t in _LOG_TEXTS]), (F.col("event_id") % 6 + 1).cast("int"))
    return table(spark, sf_dir, "events").where("event_type = 'error'").select(
        "event_id", F.concat(F.lit("[ERROR] U"), F.col("user_id").cast("string"),
                             F.lit(_LOG_HEAD + "\n "), text).alias("record"))


def dates(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, int]:
    """Order dates per customer with filing dates as text in three formats."""
    filed = F.date_add(F.to_date("o_orderdate"), (F.col("o_orderkey") % 40).cast("int"))
    kind = F.col("o_orderkey") % 3
    o = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("ticker"), F.to_date("o_orderdate").alias("m_date"),
        F.col("o_orderkey").alias("pos"),
        F.when(kind == 0, F.date_format(filed, "MM/dd/yyyy"))
        .when(kind == 1, F.date_format(filed, "yyyy-MM-dd"))
        .otherwise(F.date_format(filed, "dd/MM/yyyy")).alias("f_filing_date"))
    longest = longest_of(spark, sf_dir, "orders", o)
    numbered = with_seq(o, ["pos"], out="ingest_pos", longest=longest)
    return numbered.withColumn("ingest_pos", F.col("ingest_pos") - 1), longest


DATES = """
dates_o as (
  select o_custkey as ticker, cast(o_orderdate as date) as m_date, o_orderkey as pos,
         cast(o_orderdate as date) + cast(o_orderkey % 40 as int) as filed
  from orders),
dates as (
  select ticker, m_date, pos,
         case pos % 3 when 0 then strftime(filed, '%m/%d/%Y') when 1 then strftime(filed, '%Y-%m-%d')
              else strftime(filed, '%d/%m/%Y') end as f_filing_date,
         cast(row_number() over (partition by ticker order by pos) - 1 as bigint) as ingest_pos
  from dates_o),
sorted_dates as (
  select *, cast(row_number() over (partition by ticker order by m_date nulls last,
      cast(try_strptime(f_filing_date, '%m/%d/%Y') as date) nulls last, ingest_pos) as bigint) as seq
  from dates)"""
