from datetime import date

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from panelmend.operators import audit_review
from panelmend.plans import pipeline, rules
from panelmend.schema import AUDIT
from panelmend.sources import panel_files, vendor_log
from tests.conftest import rows


def _audit(spark, entries):
    names = [f.name for f in AUDIT.fields]
    return spark.createDataFrame([tuple(e.get(n) for n in names) for e in entries], AUDIT)


def test_read_panel_with_two_headers(spark, tmp_path):
    (tmp_path / "A.csv").write_text("m_date,m_open,f_filing_date\n01/02/2024,1.5,x\n2024-01-03,nan,\n25/01/2024,3,\n")
    (tmp_path / "B.csv").write_text("m_open,m_date,extra\n7,2024-02-01,4\n")
    (tmp_path / "C.csv").write_text("m_date\n2024-02-01\n")
    df = panel_files.read_panel(spark, str(tmp_path), exclude=["C.csv"])
    got = rows(df, "ticker", "ingest_pos")
    assert [(r["ticker"], r["ingest_pos"], str(r["m_date"]), r["m_open"], r["extra"]) for r in got] == [
        ("A", 0, "2024-01-02", 1.5, None), ("A", 1, "2024-01-03", None, None), ("A", 2, "2024-01-25", 3.0, None),
        ("B", 0, "2024-02-01", 7.0, 4.0)]
    assert panel_files.read_panel(spark, str(tmp_path), max_files=1).select("ticker").distinct().count() == 1
    assert panel_files.read_panel(spark, str(tmp_path), include=["B.csv"], typed=False).first()["m_open"] == "7"
    with pytest.raises(FileNotFoundError):
        panel_files.read_panel(spark, str(tmp_path), "*.txt")


def test_universe(spark, tmp_path):
    path = tmp_path / "u.csv"
    path.write_text('symbol,sector,ipoDate,isEtf,description\nA,Tech,2001-02-03,true,"one, ""two"""\nB,,bad,false,\n')
    got = rows(panel_files.read_universe(spark, str(path)), "symbol")
    assert str(got[0]["ipoDate"]) == "2001-02-03" and got[0]["description"] == 'one, "two"'
    assert got[1]["ipoDate"] is None and got[1]["sector"] is None
    assert panel_files.read_universe(spark, str(tmp_path / "none.csv")).count() == 0


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_write_panel(spark, tmp_path, fmt):
    numeric = spark.createDataFrame([("007", 1, 0.5)], "ticker string, seq long, v double")
    panel_files.write_panel(numeric, str(tmp_path / "numeric"), fmt)
    assert panel_files.read_saved(spark, str(tmp_path / "numeric"), fmt).first()["ticker"] == "007"
    df = spark.createDataFrame([("A", 1, 0.1), ("A", 2, None), ("B", 1, 2.5)], "ticker string, seq long, v double")
    path = str(tmp_path / "out")
    assert panel_files.write_panel(df, path, fmt) == 2
    more = df.withColumn("v", F.lit(9.0)).unionByName(spark.createDataFrame([("C", 1, 3.0)], df.schema))
    assert panel_files.write_panel(more, path, fmt, overwrite=False) == 3
    got = rows(panel_files.read_written(spark, path, fmt, df.schema), "ticker", "seq")
    assert rows(panel_files.read_saved(spark, path, fmt).select(df.columns), "ticker", "seq") == got
    assert [(r["ticker"], r["v"]) for r in got] == [("A", 0.1), ("A", None), ("B", 2.5), ("C", 3.0)]
    with pytest.raises(ValueError):
        panel_files.write_panel(df, path, "xlsx")
    with pytest.raises(FileNotFoundError):
        panel_files.write_panel(df, str(tmp_path / "no"), fmt, create_directory=False)


def test_vendor_log_spans_lines(spark, tmp_path):
    head = "skipping output as it presented the following error during data assembly:"
    entries = [("A", "Fundamental data processing error: rows are\n  not correctly sorted by date, really"),
               ("B-C", "x Negative Row.weighted_average_diluted_shares_outstanding detected"),
               ("B-C", "No data returned by unadjusted market data endpoint"), ("D", "low > high for date 2023-07-07"),
               ("E", "Negative Row.low for date"), ("F", "something   else")]
    path = tmp_path / "log.txt"
    path.write_text("".join(f"[ERROR] {t} {head}\n  {m}\n" for t, m in entries))
    got = vendor_log.parse_vendor_log(vendor_log.read_vendor_log(spark, str(path)))
    assert {(r["ticker"], r["category"]) for r in got.collect()} == {
        ("A", "FundamentalData rows not sorted by date"), ("B-C", "Negative shares outstanding"),
        ("B-C", "No unadjusted market data"), ("D", "Market data low > high"), ("E", "Negative price value"), ("F", "something else")}
    assert vendor_log.summarise_vendor_log(got).count() == 6


def test_cap_shares_by_column(spark):
    base = {"rule": "negative_fundamentals_logs", "ticker": "a", "filter_type": "correction"}
    audit = _audit(spark, [{**base, "column": c, "original_value": float(i)} for c, n in (("x", 90), ("y", 9), ("z", 1)) for i in range(n)])
    got = {r["column"]: r["count"] for r in audit_review.cap_per_ticker(audit).groupBy("column").count().collect()}
    assert got == {"x": 57, "y": 5, "z": 1}
    sides = _audit(spark, [{"rule": "financial_unequivalencies_logs", "ticker": "a", "filter_type": t, "original_value": float(i)}
                           for t in ("hard_error", "soft_warning") for i in range(50)])
    assert audit_review.cap_per_ticker(sides).count() == 64
    flat = _audit(spark, [{"rule": "ohlc_logs", "ticker": "a", "original_value": float(i)} for i in range(100)])
    assert audit_review.cap_per_ticker(flat).count() == 64


def test_text_form_and_toggles(spark):
    audit = _audit(spark, [
        {"rule": "negative_market_logs", "category": "Negative Market Data", "ticker": "a", "filter_type": "correction", "column": "m_low", "original_value": -1.5},
        {"rule": "garch_residuals_filter", "category": "GARCH Residuals", "ticker": "a", "filter_type": "statistical", "column": "c", "original_value": 2.0, "corrected_value": 1.0},
        {"rule": "unsorted_dates_logs", "category": "Date Sorting", "ticker": "b", "filter_type": "correction", "error_type": "duplicates_removed"}])
    logs = audit_review.normalize_audit(audit)
    got = [(r["original_value"], r["corrected_value"]) for r in rows(logs, "ticker", "column_involved")]
    assert got == [("2.000000", "1.000000"), ("-1.5", "Skipped"), ("", "Deduplicated")]
    key = "ticker string, date string, error_type string, column_involved string"
    flags = spark.createDataFrame([("a", "d", "e", "c", 1), ("b", "d", "e", "c", 1)], key + ", flagged_at int")
    toggles = spark.createDataFrame([("a", "d", "e", "c", 5), ("n", "d", "e", "c", 6), ("m", "d", "e", "c", 7), ("m", "d", "e", "c", 8)], key + ", toggled_at int")
    after = rows(audit_review.toggle_false_positives(flags, toggles), "ticker")
    assert [(r["ticker"], r["flagged_at"]) for r in after] == [("b", 1), ("n", 6)]


def test_full_run_and_reuse(spark, tmp_path):
    """Planted errors of several kinds are repaired, on whole and on cut tickers alike."""
    data = []
    for t in ("AA", "BB", "CC"):
        for i in range(60):
            price = 100.0 + i % 7
            data.append((t, 59 - i if t == "BB" else i, f"2024-{1 + i // 28:02d}-{1 + i % 28:02d}", price, price + 2,
                         price - 2, -price if i == 30 else (price * 60 if i == 45 else price + 1), price))
    df = spark.createDataFrame(data, "ticker string, ingest_pos long, m_date string, m_open double, m_high double, m_low double, m_close double, m_vwap double"
                               ).withColumn("m_date", F.to_date("m_date"))
    panels = []
    for block_rows in (1_000_000, 16):
        r = pipeline.run_full_pipeline(df, output=str(tmp_path / f"o{block_rows}"), block_rows=block_rows)
        assert r.saved == 3 and r.layout.blocked == (block_rows == 16)
        panels.append(rows(r.panel, "ticker", "seq"))
    assert panels[0] == panels[1] and len(panels[0]) == 180
    assert all(0 < r["m_close"] < 200 for r in panels[0])
    kinds = {r["error_type"] for r in r.audit.select("error_type").distinct().collect()}
    assert {"order_mismatch", "negative_market_value", "rolling_z_outlier", "skipped_validation"} <= kinds

    def fail():
        raise AssertionError("the saved run should be used")
    again = pipeline.load_or_run(spark, str(tmp_path / "o16"), fail)
    assert again.reused and again.panel.count() == 180 and again.audit.count() == r.audit.count()


def test_rules_are_pluggable(spark):
    df = spark.createDataFrame([("a", 0, 1.0)], "ticker string, ingest_pos long, v double").withColumn("m_date", F.lit("2024-01-01").cast("date"))
    double = rules.Rule("double", lambda d, ctx, by: (d.withColumn("v", F.col("v") * by), _audit(spark, [{"rule": "double", "ticker": "a"}])), {"by": 2})
    r = pipeline.run_sanity_checks(df, rules=[double])
    assert r.panel.first()["v"] == 2.0 and [x["rule"] for x in r.audit.collect()] == ["double"]


def test_overwriting_some_tickers_keeps_the_others(spark, tmp_path):
    from panelmend.sources.panel_files import read_written, write_panel
    both = spark.createDataFrame([("a", 1, 1.0), ("b", 1, 2.0)], "ticker string, seq long, m_close double")
    new = spark.createDataFrame([("a", 1, 9.0)], both.schema)
    for fmt in ("parquet", "csv"):
        folder = f"{tmp_path}/{fmt}"
        write_panel(both, folder, fmt)
        write_panel(new, folder, fmt)
        got = {r.ticker: r.m_close for r in read_written(spark, folder, fmt, both.schema).collect()}
        assert got == {"a": 9.0, "b": 2.0}


def test_the_audit_of_a_run_is_whole(spark):
    from panelmend.plans.pipeline import run_sanity_checks
    rows = [("a", f"{2000 + i // 300}-{1 + i % 12:02d}-{1 + i // 12 % 25:02d}", i, -1.0 - i) for i in range(1000)]
    df = spark.createDataFrame(rows, "ticker string, day string, ingest_pos long, m_close double")
    df = df.selectExpr("ticker", "cast(day as date) m_date", "ingest_pos", "m_close")
    audit = run_sanity_checks(df).audit
    assert audit.where("rule = 'negative_market_logs'").count() == 1000


def test_headers_are_read_by_executors(spark, tmp_path, monkeypatch):
    # reading them one by one on the driver took longer than all else with many files
    monkeypatch.setattr(panel_files, "_header", None)
    (tmp_path / "a b%c.csv").write_text('"m_date","m_open"\n2024-01-02,1\n2024-01-03,2\n')
    (tmp_path / "é.csv").write_text("m_date,m_open\r\n2024-01-02,3\r\n")
    (tmp_path / "z.csv").write_text("m_open,extra\n4,5\n")
    (tmp_path / "empty.csv").write_text("")
    df = panel_files.read_panel(spark, str(tmp_path))
    got = [(r["ingest_pos"], r["m_open"], r["extra"]) for r in rows(df, "ticker", "ingest_pos")]
    assert got == [(0, 1.0, None), (1, 2.0, None), (0, 4.0, 5.0), (0, 3.0, None)]
    with pytest.raises(FileNotFoundError):
        panel_files.read_panel(spark, str(tmp_path), include=["no.csv"])


def test_formats_are_written_from_the_same_rows(spark, tmp_path, monkeypatch):
    def again(*_):
        raise AssertionError("the first format is read back")
    schema = "ticker string, seq long, m_open double"
    df = spark.createDataFrame([("a", 1, 1.0), ("b", 1, None), ("a", 2, 3.0), (None, 1, 4.0)], schema)
    with monkeypatch.context() as patch:
        patch.setattr(panel_files, "read_written", again)
        assert panel_files.write_panel_formats(df, str(tmp_path)) == {"parquet": 3, "csv": 3}
    for fmt in ("parquet", "csv"):
        back = panel_files.read_written(spark, f"{tmp_path}/{fmt}", fmt, df.schema)
        assert rows(back, "ticker", "seq") == rows(df, "ticker", "seq")
        # a checksum file for each is two more processes started on a local disk
        assert not list((tmp_path / fmt).glob("ticker=*/.*.crc"))
    # what the first folder held before is in the second as well
    more = spark.createDataFrame([("c", 1, 5.0)], schema)
    panel_files.write_panel_formats(more, str(tmp_path / "again"), csv=False)
    assert panel_files.write_panel_formats(df, str(tmp_path / "again")) == {"parquet": 3, "csv": 4}


def test_ticker_files_need_no_process_each(spark, tmp_path, monkeypatch):
    names = ["A", "b/c", "x=1", "ü%", "", None, "q\"'[", "007"]
    df = spark.createDataFrame(
        [(t, s, None if s == 4 else s * 1.1e-7, [' a "q" ', "p,l", "", None][s % 4], date(2020, 1, s)) for t in names
         for s in range(1, 7)], "ticker string, seq long, v double, `na me` string, d date").repartition(
        1).sortWithinPartitions("ticker", "seq")
    df.write.partitionBy("ticker").option("header", True).csv(f"{tmp_path}/spark")

    def found(name):
        return {str(p.parent.relative_to(tmp_path / name)): p.read_bytes() for p in (tmp_path / name).rglob("*.csv")}

    # Hadoop's local file system starts a process for every file that Spark's writer makes
    monkeypatch.setattr(DataFrameWriter, "csv", None)
    panel_files.write_tickers(df, f"{tmp_path}/own", "csv", "append")
    assert len(found("own")) == 7 and found("own") == found("spark")
    files = lambda: len(list((tmp_path / "own" / "ticker=A").glob("*.csv")))
    panel_files.write_tickers(df.where("ticker = 'A'"), f"{tmp_path}/own", "csv", "append")
    assert files() == 2
    panel_files.write_tickers(df.where("ticker = 'A'"), f"{tmp_path}/own", "csv", "overwrite")
    assert files() == 1 and found("own") == found("spark")
    assert not [p for p in (tmp_path / "own").iterdir() if "staging" in p.name]
