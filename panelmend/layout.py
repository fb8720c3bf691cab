"""How one ticker's rows are laid out for ordered work.

Every ordered rule (forward fill, lag, running sums, framed statistics) reads a dense
position ``seq`` (1, 2, 3, ... within the ticker). A ticker with at most ``block_rows`` rows
is one window partition. When one is longer, tickers are cut into blocks of ``block_rows``
positions, so no task ever holds a whole hot ticker; what earlier blocks have to hand on (the last
valid value, a partial sum) is one row per block in a small written table, the last few rows are
repeated.

``seq`` being dense is what makes this cheap: the block number is plain arithmetic, and a
ticker is long exactly when it has a row at position ``block_rows + 1``.

Long tickers get their positions from a sample sort (:func:`sample_sorted`): one range exchange over
key and order, written once; rows are then counted per key and partition, and the counts give every
partition's first position. Ranks of values (exact medians and quantiles) come from the same sort.
Nothing about single tickers reaches the driver, only the length of the longest one.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelmend.workspace import Workspace

BLOCK_ROWS = 1_000_000


@dataclass(frozen=True)
class Layout:
    """Ordering of a panel: partition key, dense position and block size."""

    keys: tuple[str, ...] = ("ticker",)
    seq: str = "seq"
    block_rows: int = BLOCK_ROWS
    longest: int = 0

    @staticmethod
    def detect(df: DataFrame, seq: str = "seq", block_rows: int = BLOCK_ROWS) -> "Layout":
        """Look up the longest ticker; ``seq`` is the only column read."""
        return Layout(("ticker",), seq, block_rows, df.agg(F.max(seq)).first()[0] or 0)

    def per(self, *keys: str) -> "Layout":
        """The same positions, counted within other keys (as in long form)."""
        return replace(self, keys=keys)

    @property
    def blocked(self) -> bool:
        return self.longest > self.block_rows

    @property
    def dealt_by(self) -> str | None:
        """What a written panel's rows are dealt by: the ticker, unless one is longer than a block."""
        return None if self.blocked else self.keys[0]

    # -- block arithmetic ---------------------------------------------------------------
    def block(self) -> Column:
        return F.expr(f"(`{self.seq}` - 1) div {self.block_rows}")

    def hot_keys(self, df: DataFrame, limit: int | None = None) -> DataFrame:
        """Tickers longer than ``limit`` rows: at most total rows / limit of them."""
        return df.where(F.col(self.seq) == (limit or self.block_rows) + 1).select(*self.keys)

    def split(self, df: DataFrame) -> DataFrame:
        """The rows with their block's number, which windows and joins then share."""
        return df.withColumn("_blk", self.block()) if self.blocked else df

    def window(self, reverse: bool = False):
        """Rows of one block in order (of one ticker when nothing is blocked), see :meth:`split`."""
        order = F.col(self.seq).desc() if reverse else F.col(self.seq)
        return Window.partitionBy(*self.keys, *(["_blk"] if self.blocked else [])).orderBy(order)

    def upto(self, reverse: bool = False):
        return self.window(reverse).rowsBetween(Window.unboundedPreceding, 0)

    def _blocks_before(self, reverse: bool = False):
        order = F.col("_blk").desc() if reverse else F.col("_blk")
        return Window.partitionBy(*self.keys).orderBy(order).rowsBetween(
            Window.unboundedPreceding, -1)

    # -- scans --------------------------------------------------------------------------
    def last_valid(self, df: DataFrame, values: Mapping[str, Column],
                   reverse: bool = False) -> DataFrame:
        """Add columns holding the last non-null value of each expression up to the row.

        ``reverse`` looks the other way: the next non-null value from the row on.
        """
        if not values:
            return df
        w, parts = self.upto(reverse), self.split(df)
        if not self.blocked:
            return parts.withColumns({n: F.last(e, ignorenulls=True).over(w) for n, e in values.items()})
        pick = F.min_by if reverse else F.max_by
        before = self._blocks_before(reverse)
        carry = self._carry(
            parts, {n: pick(e, F.when(e.isNotNull(), F.col(self.seq))) for n, e in values.items()},
            lambda n: F.last(n, ignorenulls=True).over(before))
        out = parts.withColumns({n: F.last(e, ignorenulls=True).over(w) for n, e in values.items()})
        return self._handed_on(out, carry, values, lambda n, c: F.coalesce(n, c))

    def running_sum(self, df: DataFrame, values: Mapping[str, Column]) -> DataFrame:
        """Add running totals of each expression, nulls counting as nothing (0 at the start)."""
        if not values:
            return df
        w, parts = self.upto(), self.split(df)
        sums = {n: F.coalesce(F.sum(e).over(w), F.lit(0)) for n, e in values.items()}
        if not self.blocked:
            return parts.withColumns(sums)
        before = self._blocks_before()
        carry = self._carry(parts, {n: F.sum(e) for n, e in values.items()},
                            lambda n: F.sum(n).over(before))
        return self._handed_on(parts.withColumns(sums), carry, values,
                               lambda n, c: n + F.coalesce(c, F.lit(0)))

    def framed(self, df: DataFrame, before: int, make) -> DataFrame:
        """Evaluate window expressions that look at most ``before`` rows back.

        ``make(window)`` returns name -> Column over ``window`` (partitioned and ordered, no
        frame). Blocks borrow the last ``before`` rows of their predecessor: those rows are
        repeated once by ``explode`` and dropped again, so the panel is read once.
        """
        if not self.blocked:
            return df.withColumns(make(self.window()))
        own = self.block()
        tail = (F.col(self.seq) - 1) % self.block_rows >= self.block_rows - before
        spread = df.withColumn("_own", own).withColumn(
            "_blk", F.explode(F.when(tail, F.array(own, own + 1)).otherwise(F.array(own))))
        return spread.withColumns(make(self.window())).where("_blk = _own").drop("_blk", "_own")

    def lag(self, df: DataFrame, values: Mapping[str, Column]) -> DataFrame:
        if not values:
            return df
        return self.framed(df, 1, lambda w: {n: F.lag(e).over(w) for n, e in values.items()})

    # -- joins --------------------------------------------------------------------------
    def attach(self, df: DataFrame, facts: DataFrame, how: str = "left") -> DataFrame:
        """Join ``facts``, one row per key, without bringing a long key's rows together.

        With long keys the facts are first joined to the distinct (key, block) pairs, a table of one
        row per key and block, and the rows then join on both.
        """
        if not self.blocked:
            return df.join(facts, list(self.keys), how)
        parts = self.split(df)
        blocks = Workspace(df.sparkSession).table(
            parts.select(*self.keys, "_blk").distinct().join(facts, list(self.keys)), "facts")
        return parts.join(blocks, [*self.keys, "_blk"], how).drop("_blk")

    # -- helpers ------------------------------------------------------------------------
    def _carry(self, parts: DataFrame, aggs: Mapping[str, Column], scan) -> DataFrame:
        """What earlier blocks hand on, a row per block that gets anything; written, so that the
        rows' own plan reads their source once, however many steps follow each other."""
        ends = parts.groupBy(*self.keys, "_blk").agg(*[e.alias(n) for n, e in aggs.items()])
        handed = ends.select(*self.keys, "_blk", *[scan(n).alias(f"_carry_{n}") for n in aggs])
        some = reduce(lambda a, b: a | b, [F.col(f"_carry_{n}").isNotNull() for n in aggs])
        return Workspace(parts.sparkSession).table(handed.where(some), "carry")

    def _handed_on(self, out: DataFrame, carry: DataFrame, values, combine) -> DataFrame:
        # balanced on (key, block), as the window before was
        joined = out.join(carry, [*self.keys, "_blk"], "left")
        return joined.withColumns({
            n: combine(F.col(n), F.col(f"_carry_{n}")) for n in values}).drop(
            "_blk", *[f"_carry_{n}" for n in values])


def longest_key(df: DataFrame, *keys: str) -> int:
    """Rows of the largest group: one number, whatever the number of groups."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0


@dataclass(frozen=True)
class Sorted:
    """Rows in one order over all partitions.

    ``rows`` is a written table whose ``_at`` is the partition (from bit 33) and the place in it.
    ``runs`` has a row per key and partition: its first ``_at``, its rows ``_n``, those of the same key
    in earlier partitions ``_before``, and all the key's rows ``_total``.
    """

    keys: tuple[str, ...]
    rows: DataFrame
    runs: DataFrame

    def numbered(self, out: str) -> DataFrame:
        """All rows with their position 1, 2, 3, ... within the key."""
        rows = self.rows.withColumn("_part", F.shiftright("_at", 33))
        runs = self.runs.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(self.keys)],
                                F.col("_part").alias("_p"), "_first", "_before")
        same = F.col("_part") == F.col("_p")
        for i, k in enumerate(self.keys):
            same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
        joined = rows.join(runs, same)
        return joined.withColumn(out, F.col("_before") + F.col("_at") - F.col("_first") + 1).drop(
            "_at", "_part", "_p", "_first", "_before", *[f"_k{i}" for i in range(len(self.keys))])

    def at_ranks(self, ranks: Column) -> DataFrame:
        """The rows at the wanted ranks of each key: ``ranks`` is an array made from ``_total``.

        A rank asked for twice gives its row twice.
        """
        wanted = self.runs.select(
            "_first", "_before", "_n", F.explode(ranks).alias("_rank")).where(
            "_rank > _before and _rank <= _before + _n").select(
            (F.col("_first") + F.col("_rank") - F.col("_before") - 1).alias("_at"))
        found = Workspace(self.rows.sparkSession).table(wanted, "ranks")
        return self.rows.join(found, "_at").drop("_at")


def sample_sorted(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> Sorted:
    """Sort by keys and order (nulls last) with one range exchange, and write the result.

    Spark picks the ranges from a sample, so a key with most of all rows covers most partitions.
    ``order`` should end in something that tells rows apart: rows alike in all stay together.
    """
    by = [F.col(k).asc_nulls_last() for k in (*keys, *order)]
    workspace = Workspace(df.sparkSession)
    rows = workspace.table(df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn(
        "_at", F.monotonically_increasing_id()), "sorted")
    found = rows.groupBy(*keys, F.shiftright("_at", 33).alias("_part")).agg(
        F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    key = Window.partitionBy(*keys)
    before = key.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = workspace.table(found.withColumns({
        "_before": F.coalesce(F.sum("_n").over(before), F.lit(0)), "_total": F.sum("_n").over(key)}), "runs")
    return Sorted(tuple(keys), rows, runs)


def with_seq(df: DataFrame, order: Sequence[str], key: str = "ticker", out: str = "seq",
             block_rows: int = BLOCK_ROWS, longest: int | None = None) -> DataFrame:
    """Number each ticker's rows 1..n in the given order (nulls last).

    While no ticker has more than ``block_rows`` rows (``longest``; counted when not given) this is a
    window over the ticker, whose exchange later rules share. Else rows are numbered by a sample
    sort, which splits any ticker. The last order column is the tie-break.
    """
    if longest is None:
        longest = longest_key(df, key)
    if longest <= block_rows:
        w = Window.partitionBy(key).orderBy(*[F.col(c).asc_nulls_last() for c in order])
        return df.withColumn(out, F.row_number().over(w).cast("long"))
    return sample_sorted(df, [key], order).numbered(out).select(*df.columns, out)


def normalise_missing(df: DataFrame) -> DataFrame:
    """Turn NaN and infinities in floating columns into null, so missing means one thing."""
    fixes = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.col(f.name)
            fixes[f.name] = F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c)
    return df.withColumns(fixes) if fixes else df
