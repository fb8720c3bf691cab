"""Working with the audit trail: union, caps, summaries, text form, search and flags."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelmend.operators.audit_rows import first_per
from panelmend.schema import AUDIT

# fixed values
MAX_PER_TICKER = 64
CONTEXT_ROWS = 30
KEY = ["ticker", "date", "error_type", "column_involved"]
BY_SIDE, BY_COLUMN = "financial_unequivalencies_logs", "negative_fundamentals_logs"


def audit_union(*audits: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), audits)


def _share() -> Column:
    """What a rule's rows are counted by: hard or soft side, column, or nothing."""
    return (F.when(F.col("rule") == BY_SIDE, F.col("filter_type"))
            .when(F.col("rule") == BY_COLUMN, F.col("column")).otherwise(F.lit("")))


def cap_per_ticker(audit: DataFrame, limit: int = MAX_PER_TICKER) -> DataFrame:
    """At most ``limit`` rows per ticker and rule.

    The accounting rule gives half to each side; negative statement values share the limit over
    columns in proportion to their rows, at least one each.
    """
    keyed = audit.withColumn("_share", _share())
    order = [F.coalesce("date", "date_start").asc_nulls_last(), F.col("error_type"),
             F.col("column"), F.col("original_value"), F.col("corrected_value")]
    w = Window.partitionBy("ticker", "rule", "_share").orderBy(*order)
    # the constant bound lets tasks drop surplus rows before the shuffle
    top = keyed.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= limit)
    counts = keyed.where(F.col("rule") == BY_COLUMN).groupBy("ticker", "rule", "_share").agg(
        F.count(F.lit(1)).alias("_n"))
    totals = counts.withColumn("_all", F.sum("_n").over(Window.partitionBy("ticker", "rule")))
    joined = top.join(totals, ["ticker", "rule", "_share"], "left")
    allowed = (F.when(F.col("rule") == BY_SIDE, F.lit(limit // 2))
               .when(F.col("rule") == BY_COLUMN, F.greatest(
                   F.lit(1), F.floor(F.col("_n") / F.col("_all") * limit)))
               .otherwise(F.lit(limit)))
    return joined.where(F.col("_rn") <= allowed).select(*audit.columns)


def audit_summary(audit: DataFrame) -> DataFrame:
    """Rows per rule and share, with subtotals per rule and a grand total (nulls)."""
    keyed = audit.select("rule", F.when(_share() != "", _share()).otherwise("all").alias("key"))
    return keyed.rollup("rule", "key").agg(F.count(F.lit(1)).alias("total_logs"))


# -- text form -----------------------------------------------------------------------------------
def _number(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(""))


def _fixed(c: str) -> Column:
    garch = F.col("rule") == "garch_residuals_filter"
    return F.when(F.col(c).isNull(), "").when(garch, F.format_string("%.6f", c)).otherwise(
        F.format_string("%.4f", c))


def _whole(c: str) -> Column:
    return F.coalesce(F.col(c).cast("long").cast("string"), F.lit(""))


def _payload(name: str) -> Column:
    return F.try_element_at("payload", F.lit(name))


def _original() -> Column:
    rule, kind = F.col("rule"), F.col("error_type")
    hard = F.concat(F.lit("Current="), _payload("current"), F.lit(", Noncurrent="),
                    _payload("noncurrent"))
    cash = F.concat(F.lit("Period End="), _payload("total"), F.lit(", Cash&Equiv="),
                    _payload("component_sum"))
    return (F.when(F.col("filter_type") == "info", "")
            .when(F.col("filter_type") == "statistical", _fixed("original_value"))
            .when(F.col("filter_type") == "hard_error", hard)
            .when(kind == "cash_mismatch", cash)
            .when(F.col("filter_type") == "soft_warning", _payload("components"))
            .when(rule == "unsorted_dates_logs", _whole("original_value"))
            .when(rule == "zero_wipeout_logs",
                  F.concat(F.lit("0 (volume="), _payload("volume"), F.lit(")")))
            .when(rule == "shares_outstanding_logs", F.col("column"))
            .otherwise(_number("original_value")))


def _corrected() -> Column:
    rule, kind = F.col("rule"), F.col("error_type")
    hard = F.concat(F.lit("Current="), _payload("corrected_current"), F.lit(", Noncurrent="),
                    _payload("corrected_noncurrent"))
    return (F.when(F.col("filter_type").isin("info", "soft_warning"), "Not applicable")
            .when(F.col("filter_type") == "statistical", _fixed("corrected_value"))
            .when(F.col("filter_type") == "hard_error", hard)
            .when(kind == "duplicates_removed", "Deduplicated")
            .when(kind == "no_date_columns", "Not applicable")
            .when(rule == "unsorted_dates_logs", _whole("corrected_value"))
            .when(rule.isin(BY_COLUMN, "zero_wipeout_logs", "shares_outstanding_logs"),
                  "Forward filled")
            .when((rule == "negative_market_logs") & F.col("corrected_value").isNull(), "Skipped")
            .otherwise(_number("corrected_value")))


def normalize_audit(audit: DataFrame) -> DataFrame:
    """The ten text columns reviewers see; ``raw_log`` is the whole audit row as JSON."""
    day = F.coalesce("date", "date_start")
    return audit.select(
        "ticker", F.coalesce(F.date_format(day, "yyyy-MM-dd"), F.lit("")).alias("date"),
        F.col("category").alias("error_category"), "error_type",
        F.coalesce("column", F.lit("")).alias("column_involved"),
        _original().alias("original_value"), _corrected().alias("corrected_value"),
        F.coalesce("message", F.lit("")).alias("message"), "filter_type",
        F.to_json(F.struct(*[f.name for f in AUDIT.fields])).alias("raw_log"))


# -- review ------------------------------------------------------------------------------------------
def audit_tickers(audit: DataFrame) -> DataFrame:
    return audit.select("ticker").distinct().orderBy("ticker")


def _conditions(ticker, category, filter_type) -> Column:
    keep = F.lit(True)
    if ticker is not None:
        keep = keep & (F.col("ticker") == ticker)
    if category is not None:
        keep = keep & (F.col("error_category") == category)
    if category == "Accounting Mismatch" and filter_type not in (None, "all"):
        keep = keep & (F.col("filter_type") == filter_type)
    return keep


def audit_facets(logs: DataFrame, ticker=None, category=None, filter_type=None,
                 limit: int | None = None) -> DataFrame:
    """Values to filter by: dates, columns and types; ``limit`` keeps the first of each list."""
    found = logs.where(_conditions(ticker, category, filter_type))

    pairs = [F.struct(F.lit(facet).alias("facet"), F.col(column).cast("string").alias("value"))
             for facet, column in (("date", "date"), ("column", "column_involved"),
                                   ("type", "error_type"))]
    values = (found.select(F.explode(F.array(*pairs)).alias("x")).select("x.*")
              .where(F.col("value") != "").distinct())
    return first_per(values, ["facet"], [F.col("value")], limit)


def _matching(logs, ticker, category, filter_type, dates, columns, types) -> DataFrame:
    found = logs.where(_conditions(ticker, category, filter_type))
    for name, wanted in (("date", dates), ("column_involved", columns), ("error_type", types)):
        for value in wanted or []:
            found = found.where(F.col(name) == value)
    return found


def audit_search(logs: DataFrame, ticker=None, category=None, filter_type=None, dates=None,
                 columns=None, types=None, limit: int | None = None) -> DataFrame:
    """Matching rows in a fixed order, all or the first; conditions all have to hold."""
    found = _matching(logs, ticker, category, filter_type, dates, columns, types)
    order = ["ticker", "date", "error_type", "column_involved", "original_value",
             "corrected_value", "message"]
    found = found.orderBy(*order)
    return found if limit is None else found.limit(limit)


def audit_match_count(logs: DataFrame, ticker=None, category=None, filter_type=None, dates=None,
                      columns=None, types=None) -> DataFrame:
    """How many rows match, for a search that shows only the first."""
    return _matching(logs, ticker, category, filter_type, dates, columns, types).agg(
        F.count(F.lit(1)).alias("match_count"))


def drop_soft_warnings(logs: DataFrame) -> DataFrame:
    return logs.where(F.col("filter_type") != "soft_warning")


def mark_false_positives(logs: DataFrame, flags: DataFrame) -> DataFrame:
    """Add ``is_false_positive``: the row's four-part key is among the flags."""
    keys = flags.select(*KEY).distinct().withColumn("_flagged", F.lit(True))
    return logs.join(keys, KEY, "left").withColumn(
        "is_false_positive", F.col("_flagged").isNotNull()).drop("_flagged")


def toggle_false_positives(flags: DataFrame, toggles: DataFrame) -> DataFrame:
    """Flags after a batch of toggles: an odd number of toggles flips a key.

    A key that becomes flagged carries the time of its last toggle.
    """
    flips = toggles.groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("_n"), F.max("toggled_at").alias("_at"))
    joined = flags.withColumn("_was", F.lit(True)).join(flips, KEY, "full_outer")
    was = F.coalesce("_was", F.lit(False))
    odd = F.coalesce(F.col("_n") % 2 == 1, F.lit(False))
    return joined.where(was != odd).select(
        *KEY, F.when(was, F.col("flagged_at")).otherwise(F.col("_at")).alias("flagged_at"))


# -- looking at the data behind a log row -----------------------------------------------------------
def before_after(raw: DataFrame, corrected: DataFrame, column: str,
                 date: str = "m_date") -> DataFrame:
    """Rows whose value the cleaning changed, with both values."""
    both = raw.select("ticker", "seq", date, F.col(column).alias("original")).join(
        corrected.select("ticker", "seq", F.col(column).alias("cleaned")), ["ticker", "seq"])
    return both.where(~F.col("original").eqNullSafe(F.col("cleaned")))


def error_context(panel: DataFrame, errors: DataFrame, column: str, rows: int = CONTEXT_ROWS,
                  date: str = "m_date") -> DataFrame:
    """Values up to ``rows`` positions around each error date of a ticker.

    Each error asks for its positions by number, so the join is on (ticker, seq) and stays even
    when one ticker has most of the rows.
    """
    at = errors.select("ticker", date).distinct().join(
        panel.select("ticker", date, "seq"), ["ticker", date]).groupBy("ticker", date).agg(
        F.min("seq").alias("error_seq"))
    asked = at.select("ticker", F.col(date).alias("error_date"), F.explode(F.sequence(
        F.col("error_seq") - rows, F.col("error_seq") + rows)).alias("seq"))
    return asked.join(panel.select("ticker", "seq", date, F.col(column).alias("value")),
                      ["ticker", "seq"])


def error_dates(logs: DataFrame, column: str, category=None,
                limit: int | None = None) -> DataFrame:
    """Error dates per ticker for one column; all its dates where no log names the column."""
    found = logs.where(_conditions(None, category, None)).withColumn(
        "_named", F.col("column_involved").contains(column))
    named = found.groupBy("ticker").agg(F.bool_or("_named").alias("_any"))
    dates = (found.join(named, "ticker").where(F.col("_named") | ~F.col("_any"))
             .where(F.col("date") != "").select("ticker", "date").distinct())
    return first_per(dates, ["ticker"], [F.col("date")], limit)


def accounting_series(df: DataFrame, date: str = "m_date") -> DataFrame:
    """Assets against liabilities + equity + noncontrolling interest, missing counting as 0."""
    zero = F.lit(0.0)
    parts = [F.coalesce(F.col(c), zero) for c in (
        "fbs_liabilities", "fbs_stockholder_equity", "fbs_noncontrolling_interest")
        if c in df.columns]
    return df.select("ticker", "seq", date, F.col("fbs_assets").alias("assets"),
                     sum(parts[1:], parts[0]).alias("claims"))
