"""A ticker cut into blocks must give what one window over the whole ticker gives."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelmend.functions import calculations
from panelmend.layout import Layout, longest_key, normalise_missing, sample_sorted, with_seq
from panelmend.operators import market, negative_prices, rolling_z, sector_outliers, statement_repairs
from tests.conftest import rows


@pytest.fixture(scope="module")
def panel(spark):
    """One hot ticker and two short ones, with runs of nulls longer than a block."""
    data = [("hot", i, None if i % 7 in (1, 2) or 20 <= i <= 45 else float(i * 37 % 101))
            for i in range(1, 101)]
    data += [("a", i, float(i)) for i in range(1, 6)] + [("b", 1, None)]
    return spark.createDataFrame(data, "ticker string, seq long, v double").cache()


def both(panel, step):
    plain = Layout(longest=100)
    blocked = Layout(longest=100, block_rows=10)
    assert blocked.blocked and not plain.blocked
    return rows(step(plain), "ticker", "seq"), rows(step(blocked), "ticker", "seq")


@pytest.mark.parametrize("step", [
    lambda p: lambda l: l.last_valid(p, {"x": F.col("v")}),
    lambda p: lambda l: l.last_valid(p, {"x": F.col("v")}, reverse=True),
    lambda p: lambda l: l.last_valid(p, {"v": F.when(F.col("v") > 50, F.col("v"))}),
    lambda p: lambda l: l.running_sum(p, {"x": F.col("v"), "n": F.when(F.col("v") > 3, F.lit(1))}),
    lambda p: lambda l: l.lag(p, {"x": F.col("v")}),
    lambda p: lambda l: l.framed(p, 9, lambda w: {
        "m": F.avg("v").over(w.rowsBetween(-9, -1)), "c": F.count("v").over(w.rowsBetween(-9, -1))}),
], ids=["last", "next", "replace", "sum", "lag", "frame"])
def test_blocks_change_nothing(panel, step):
    plain, blocked = both(panel, step(panel))
    assert plain == blocked and len(plain) == 106


def test_struct_values_and_composite_keys(spark, panel):
    twice = panel.withColumn("column", F.explode(F.array(F.lit("x"), F.lit("y"))))

    def step(layout):
        return layout.per("ticker", "column").last_valid(
            twice, {"s": F.when(F.col("v") > 60, F.struct("seq", "v"))}, reverse=True)
    plain, blocked = (rows(step(l), "ticker", "column", "seq")
                      for l in (Layout(longest=100), Layout(longest=100, block_rows=10)))
    assert plain == blocked


def test_detect(panel):
    assert Layout.detect(panel, block_rows=10).blocked
    assert not Layout.detect(panel).blocked


ORDERS = {
    "date": "if(pos % 11 <> 0, date_add(date'2024-01-01', cast(pos % 3 as int)), null)",
    "time": "if(pos % 7 <> 0, timestamp_seconds(pos % 5), null)",
    "decimal": "cast(pos * 7 % 13 / 3 as decimal(20, 5))",
    "text": "concat('é', pos * 31 % 17)",
    "double": "if(pos % 5 <> 0, sin(pos), null)",
    "boolean": "pos % 2 = 0",
    "bytes": "cast(cast(pos % 19 as string) as binary)",
}


@pytest.mark.parametrize("kind", ORDERS)
def test_numbering_when_one_ticker_has_nine_tenths(spark, kind):
    """A sample sort numbers as a window does, for any type; ties go by position, nulls last."""
    df = spark.range(3000).select(
        F.when(F.col("id") % 10 != 0, "hot").when(F.col("id") % 100 != 0, F.concat(
            F.lit("t"), (F.col("id") % 70).cast("string"))).alias("ticker"),
        F.col("id").alias("pos")).withColumn("o", F.expr(ORDERS[kind])).repartition(7, "pos")
    assert longest_key(df, "ticker") == 2700
    plain = rows(with_seq(df, ["o", "pos"]), "pos")
    split = rows(with_seq(df, ["o", "pos"], block_rows=50), "pos")
    assert plain == split
    assert sorted(r["seq"] for r in split if r["ticker"] == "hot") == list(range(1, 2701))


def test_a_long_ticker_is_sorted_by_several_tasks(spark):
    df = spark.range(20_000).select(F.lit("hot").alias("ticker"), (F.col("id") * 7919 % 20_000).alias("pos"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # a small table, unmerged
    try:
        runs = sample_sorted(df, ["ticker"], ["pos"]).runs.collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(runs) > 1 and max(r["_n"] for r in runs) < 0.7 * 20_000
    assert {r["_total"] for r in runs} == {20_000}


def test_ranks_are_found_by_place(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), (F.col("id") * 37 % 1000).alias("v"))
    got = sample_sorted(df, ["k"], ["v"]).at_ranks(F.array(F.lit(1), F.col("_total"), F.col("_total")))
    want = sorted((k, v) for k in range(3) for some in [[i * 37 % 1000 for i in range(1000) if i % 3 == k]]
                  for v in (min(some), max(some), max(some)))
    assert sorted((r["k"], r["v"]) for r in got.collect()) == want


def scans(df, path):
    """How often a plan reads the table at ``path``."""
    text = df._jdf.queryExecution().executedPlan().toString()
    return sum(path in line for line in text.splitlines() if "FileScan" in line)


STEPS = {
    "C1": lambda df, l: statement_repairs.fill_negative_statements(df, l, ["m_open", "m_close"]),
    "C3": lambda df, l: negative_prices.fill_negative_prices(df, l, ["m_open", "m_close"]),
    "C5": lambda df, l: statement_repairs.fill_zero_shares(df, l, ["shares"]),
    "C7": lambda df, l: statement_repairs.fill_jumps(df, l, ["shares", "m_close"]),
    "C8": lambda df, l: statement_repairs.fill_correlated_jumps(df, l, "m_close", "shares"),
    "C20": lambda df, l: market.repair_splits(df, l),
    "D": lambda df, l: calculations.with_calculations(
        df, [calculations.MARKET[c] for c in ("c_fixed_high", "c_fixed_low", "c_fixed_vwap", "c_fixed_open")], l),
    "E1": lambda df, l: rolling_z.rolling_z_hits(df, l, ["m_open", "m_close"]),
    "chain": lambda df, l: STEPS["C7"](STEPS["C5"](STEPS["C1"](df, l), l), l),
}


@pytest.mark.parametrize("step", STEPS)
def test_blocked_plans_read_the_panel_twice_at_most(spark, tmp_path, step):
    path = str(tmp_path / "base.parquet")
    value = lambda n: F.when(F.col("id") % 17 != 0, (F.col("id") * n % 23 - 4).cast("double") * 10)
    (spark.range(1, 301).select(
        F.when(F.col("id") <= 240, "hot").otherwise("cold").alias("ticker"),
        F.when(F.col("id") <= 240, F.col("id")).otherwise(F.col("id") - 240).alias("seq"),
        *[value(n).alias(c) for n, c in ((3, "m_open"), (5, "m_close"), (7, "m_high"), (9, "m_low"), (11, "m_vwap"),
                                         (13, "m_volume"), (15, "shares"))],
        value(19).alias("m_open_split_adjusted"),
        F.when(F.col("id") % 50 == 0, F.lit(2.0)).alias("s_split_date_numerator"),
        F.when(F.col("id") % 50 == 0, F.lit(1.0)).alias("s_split_date_denominator")).write.parquet(path))
    df = spark.read.parquet(path)
    blocked = STEPS[step](df, Layout(longest=240, block_rows=20))
    assert scans(blocked, path) <= 2
    plain = STEPS[step](df, Layout(longest=240))
    order = [c for c in ("ticker", "column", "seq") if c in plain.columns]
    assert rows(blocked, *order) == rows(plain.select(blocked.columns), *order)


def test_facts_reach_long_tickers_block_by_block(panel):
    facts = panel.groupBy("ticker").agg(F.count("v").alias("n")).where("ticker <> 'b'")
    plain, blocked = both(panel, lambda l: l.attach(panel, facts))
    assert plain == blocked and len(plain) == 106
    plan = Layout(longest=100, block_rows=10).attach(panel, facts)._jdf.queryExecution().executedPlan().toString()
    assert "_blk" in plan


def test_sectors_and_quarters_of_long_tickers(spark, panel):
    """The universe and corrected quarters reach a long ticker block by block."""
    universe = spark.createDataFrame([("hot.csv", "S"), ("hot", "R"), ("a", "T"), (None, "U")], "symbol string, sector string")
    plain, blocked = both(panel, lambda l: sector_outliers.assign_sector(panel, universe, l))
    assert plain == blocked and {(r["ticker"], r["sector"]) for r in plain} == {("hot", "S"), ("a", "T"), ("b", "Unknown")}
    daily = panel.withColumns({"quarter_id": F.when(F.col("seq") <= 70, 20241).otherwise(20242).cast("long"),
                               "m_date": F.lit(None).cast("date")})
    bad = spark.createDataFrame([("hot", 20242)], "ticker string, quarter_id long")
    plain, blocked = both(daily, lambda l: sector_outliers.repair_quarters(daily, bad, ["v"], layout=l))
    assert plain == blocked and len({r["v"] for r in plain if r["ticker"] == "hot" and r["seq"] > 70}) == 1


def test_normalise_missing(spark):
    df = spark.createDataFrame(pd.DataFrame({"k": [1, 2, 3, 4], "v": [1.0, float("inf"), float("nan"), -2.0]}))
    assert [r["v"] for r in rows(normalise_missing(df), "k")] == [1.0, None, None, -2.0]
