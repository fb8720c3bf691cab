"""Work that must not grow with the number of steps: exchanges, reads of a source, tables left behind."""

import os
from datetime import date, timedelta

from pyspark.sql import Window
from pyspark.sql import functions as F

from catalog import fixtures as X
from panelmend.layout import Layout
from panelmend.operators import negative_prices
from panelmend.operators.series_points import apply_repairs
from panelmend.plans import pipeline, rules
from panelmend.workspace import Workspace, joined_where_dealt


def _lines(spark, path):
    rows = [(s, o, n, 7 * o + n, date(2020, 1, 1) + timedelta(o % 40), float(100 + o + n), float(n))
            for s in range(1, 6) for o in range(60) for n in (1, 2)]
    spark.createDataFrame(rows, "l_suppkey long, l_orderkey long, l_linenumber long, l_partkey long, l_shipdate date, "
                          "l_extendedprice double, l_quantity double").write.parquet(f"{path}/lineitem.parquet")


def test_bars_take_one_exchange(spark, tmp_path):
    _lines(spark, str(tmp_path))
    df, _ = X.bars(spark, str(tmp_path))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert df.count() == 200


def test_negative_repairs_read_their_source_twice(spark):
    rows = [(t, s, -1.0 if s in (5, 6, 20) else float(s)) for t in range(3) for s in range(1, 31)]
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for pdf in batches:
            read.add(len(pdf))
            yield pdf

    kind = "ticker long, seq long, m_close double"
    df = spark.createDataFrame(rows, kind).mapInPandas(counted, kind)
    got = {(r.ticker, r.seq): r.corrected for r in negative_prices.negative_repairs(
        df, Layout(longest=30), ["m_close"]).collect()}
    assert {k: round(v, 9) for k, v in got.items()} == {(t, s): float(s) for t in range(3) for s in (5, 6, 20)}
    # once for the minima, once for the windows; a third time when the values were joined
    assert read.value == 2 * len(rows)


def test_superseded_panels_are_deleted(spark):
    rows = [(t, s, date(2020, 1, 1) + timedelta(s), float(s + t)) for t in range(3) for s in range(30)]
    df = spark.createDataFrame(rows, "ticker long, ingest_pos long, m_date date, m_close double")

    def plus(df, ctx):
        # the audit reads the panel before the rule
        return df.withColumn("m_close", df.m_close + 1), rules.market.ohlc_audit(df).limit(0).union(
            rules.no_rows(df, "ohlc_logs"))

    root = spark.conf.get("spark.checkpoint.dir")

    def panels():
        return sum(name.startswith(("sorted-", "step")) for _, folders, _ in os.walk(root) for name in folders)

    before = panels()
    steps = [rules.Rule(f"step{i}", plus, cut=True) for i in range(3)]
    result = pipeline.run_full_pipeline(df, sanity=steps[:2], statistical=steps[2:])
    assert {r.ticker: r[1] for r in result.panel.groupBy("ticker").sum("m_close").collect()} == {
        t: sum(s + t + 3.0 for s in range(30)) for t in range(3)}
    assert result.audit.count() == 0
    assert panels() - before == 1


def test_written_panels_are_not_dealt_again(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(name, "-1")
    workspace = Workspace(spark)
    try:
        df = spark.createDataFrame([(t, s, float(s)) for t in range(9) for s in range(1, 21)],
                                   "ticker long, seq long, v double")
        panel = workspace.table(df, "panel", by="ticker")
        with joined_where_dealt(spark):
            summed = panel.withColumn("n", F.sum("v").over(Window.partitionBy("ticker").orderBy("seq")))
            assert "Exchange" not in summed._jdf.queryExecution().executedPlan().toString()
            repairs = workspace.table(df.where("seq = 3").selectExpr(
                "ticker", "seq", "'v' as column", "-1D as corrected"), "repairs")
            fixed = apply_repairs(summed, repairs, ["v"], Layout(longest=20))
            # only the repairs are dealt
            assert fixed._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
            again = workspace.table(fixed, "again", by="ticker")
        assert [r.v for r in again.where("ticker = 4").orderBy("seq").collect()][:4] == [1.0, 2.0, -1.0, 4.0]
        assert again.columns == summed.columns and again.count() == 180
    finally:
        spark.conf.unset(name)
        workspace.clear()
    assert not os.path.exists(workspace.root)
    assert not [t for t in spark.catalog.listTables() if t.name in workspace._buckets]


def test_quarters_reach_bars_where_they_lie(spark, tmp_path):
    rows = [(s, o, n, 7 * o + n, date(2020, 1, 1) + timedelta(o), float(100 + o + n), float(n), "AN"[o % 2])
            for s in range(1, 6) for o in range(200) for n in (1, 2)]
    spark.createDataFrame(rows, "l_suppkey long, l_orderkey long, l_linenumber long, l_partkey long, l_shipdate date, "
                          "l_extendedprice double, l_quantity double, l_returnflag string").write.parquet(
        f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(s, s) for s in range(1, 6)], "s_suppkey long, s_nationkey long").write.parquet(
        f"{tmp_path}/supplier.parquet")
    with joined_where_dealt(spark):
        df, layout = X.panel(spark, str(tmp_path))
        # the bars' own exchange, the statements' sum and the statements' way to the bars
        assert df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 3
    assert df.count() == 1000 and df.where("fbs_assets is null").count() == 0
