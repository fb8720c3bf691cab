"""Mixing sources to target weights by Pareto order sampling.

Every document of a source first gets the same number of certain whole copies. What is then still
missing from the source's target is drawn: documents are ranked by random odds divided by inclusion
odds, ``(u / (1 - u)) / odds`` (Rosen's Pareto order sampling), and taken in that order up to a
fixed size in words.

* Randomness is a keyed digest of ``doc_id``, so reruns agree whatever the partitioning.
* The inclusion odds grow with the square root of a document's words.
* Long documents (over a fiftieth of what is missing) are ranked by themselves for their share of
  the words; the others then fill up what is left. Each cut is where the words taken come nearest
  to the budget, so a source misses its target by half of one short document, unless it has too few
  of them to make up for the long ones.

Defined cases: a null or empty text has size 0 and adds nothing; a null source is a source of its
own, ordered last; rows with the same ``doc_id`` (or none) are separate rows, alike in rank, equal
ones being interchangeable; an empty table gives an empty result; other columns of the input are
ignored, whatever their names, unless ``carry`` is set.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelmend.llm.common import Scratch, n_words

WEIGHTS = (5, 2, 1)
MAX_COPIES = 3
SEED = "mix-1"
#: A document is long if it has more than this part of the words still missing.
LONG = 0.02
#: Documents of a source that are ranked in one task at most, on average.
RANKED_TOGETHER = 20_000


def uniform(doc_id: Column, seed: str = SEED) -> Column:
    """A number in (0, 1) from the digest of seed and id; the same in every run and engine."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))))
    return ((F.conv(F.substring(digest, 1, 13), 16, 10).cast("long").cast("double") + 0.5)
            / float(2 ** 52))


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """One row per source: ``source, source_size, target``.

    ``sizes`` has one row per source with ``source, source_size``. Weights repeat in code point
    order of the sources. Targets are ``min(max_copies * size, level * weight)`` for the level at
    which they add up to all words; it is found from running sums in order of saturation. The
    windows run over one row per source, not per document.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    numbered = (sizes.withColumn("n", F.row_number().over(order) - 1)
                .withColumn("w", F.element_at(F.array(*[F.lit(x) for x in weights]),
                                              (F.col("n") % len(weights) + 1).cast("int")))
                .withColumn("cap", F.lit(max_copies) * F.col("source_size")))
    up = Window.orderBy(F.col("cap") / F.col("w"), "n")
    before = up.rowsBetween(Window.unboundedPreceding, -1)
    after = up.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    levelled = (numbered
                .withColumn("total", F.sum("source_size").over(
                    up.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
                .withColumn("level", (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0)))
                            .cast("double") / F.sum("w").over(after))
                .withColumn("full", F.col("cap") <= F.col("w") * F.col("level")))
    # the first source that is not full settles the level of all that follow it
    settled = F.first(F.when(~F.col("full"), F.col("level")), ignorenulls=True).over(
        up.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return levelled.withColumn("settled", settled).select(
        "source", "source_size",
        F.when(F.col("full"), F.col("cap").cast("double"))
        .otherwise(F.col("w") * F.col("settled")).alias("target"))


def mix(docs: DataFrame, weights=WEIGHTS, max_copies: int = MAX_COPIES, seed: str = SEED,
        carry: bool = False, ranked_together: int = RANKED_TOGETHER) -> DataFrame:
    """Copies of every document: ``doc_id, source, size, source_size, target, copies, taken``.

    ``carry`` adds ``row``, the struct of the input's columns. A source of any size is spread over
    buckets of rank; only the bucket that holds the cut is ordered row by row. Cuts are found on
    ids, sizes and ranks alone; ``row`` is written once and only compared with its source's cuts.
    """
    scratch = Scratch(docs.sparkSession)
    u = uniform(F.col("doc_id"), seed)
    first = docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), u.alias("u"),
                        *([F.struct(*docs.columns).alias("row")] if carry else []))
    rank = F.col("u") / (1 - F.col("u")) / F.sqrt(F.col("size").cast("double"))
    sized = scratch.table(first.select(
        *first.columns, F.when(F.col("size") > 0, rank).alias("rank"),
        F.monotonically_increasing_id().alias("uid")), "sized")
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"),
                                       F.count(F.lit(1)).alias("n_docs"))
    targets = source_targets(sums.select("source", "source_size"), weights, max_copies)
    n_docs = sums.select(F.col("source").alias("s"), "n_docs")
    per = targets.join(n_docs, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    per = scratch.table(per.select(
        F.col("source").alias("s"), "source_size", "target",
        F.floor(ratio).alias("whole"),
        (F.col("target") - F.floor(ratio) * F.col("source_size")).alias("missing"),
        F.ceil(F.col("n_docs") / ranked_together).alias("buckets"),
        (F.col("source_size") / F.col("n_docs")).alias("mean")), "sources")
    is_long = F.col("size") > F.col("missing") * LONG
    ranked = sized.select("doc_id", "source", "size", "rank", "uid").join(
        per, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    long, short = ranked.where(is_long), ranked.where(~is_long)
    share = long.groupBy("source", "missing", "source_size").agg(F.sum("size").alias("words"))
    of_long = scratch.table(cuts(long, share.select(
        "source", (F.col("missing") * F.col("words") / F.col("source_size")).alias("budget"),
        F.col("missing").alias("most"), (F.col("source_size") - F.col("words")).alias("others"))), "long")
    spent = of_long.select(F.col("s").alias("s3"), "spent")
    left = (per.join(spent, F.col("s").eqNullSafe(F.col("s3")), "left")
            .select(F.col("s").alias("source"),
                    (F.col("missing") - F.coalesce("spent", F.lit(0))).alias("budget"),
                    F.lit(float("inf")).alias("most"), F.lit(0).alias("others")))
    for kind, found in (("long", of_long), ("short", cuts(short, left))):
        found = found.select(F.col("s").alias("s3"), F.struct("cut_bucket", "last").alias(kind))
        per = per.join(found, F.col("s").eqNullSafe(F.col("s3")), "left").drop("s3")
    per = scratch.table(per, "cuts")
    # one row per source is joined, so documents stay where they are
    joined = sized.join(per, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    cut = F.when(is_long, F.col("long")).otherwise(F.col("short"))
    drawn = F.coalesce((bucket() < cut["cut_bucket"]) | (
        (bucket() == cut["cut_bucket"]) & (place() <= cut["last"])), F.lit(False))
    copies = F.col("whole") + F.when(drawn, 1).otherwise(0)
    return joined.select(
        "doc_id", "source", "size", "source_size", "target", copies.cast("long").alias("copies"),
        (copies * F.col("size")).cast("long").alias("taken"), *(["row"] if carry else []))


def bucket() -> Column:
    """Ranks lie in (0, inf) and are mapped monotonously to their source's buckets."""
    spread = F.col("rank") / (F.col("rank") + 1 / F.sqrt(F.greatest(F.col("mean"), F.lit(1.0))))
    return F.when(F.col("size") > 0, F.floor(spread * F.col("buckets")))


def place() -> Column:
    """A row's place in the ranking of its source."""
    return F.struct("rank", "doc_id", "size", "uid")


def cuts(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """How far down each source's ranking rows are drawn, up to its budget in words.

    ``s, cut_bucket, last, spent``: all rows of earlier buckets, those of the cut bucket up to the
    place ``last`` (none if null), and their words. A row that would take more than ``most`` is drawn
    only if the other documents of the source, ``others`` words in all, would leave a larger gap
    without it; what holds for a row holds for all before it.

    Words are summed by bucket; only the bucket that holds the cut is ordered row by row.
    """
    placed = rows.withColumn("bucket", bucket())
    totals = placed.where("size > 0").groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    upto = Window.partitionBy("source").orderBy("bucket")
    budgets = budgets.withColumnRenamed("source", "s")
    cut = (totals.withColumn("before", F.sum("words").over(upto) - F.col("words"))
           .join(budgets, F.col("source").eqNullSafe(F.col("s"))).where("before < budget")
           .groupBy("s", "budget", "most", "others").agg(F.max("bucket").alias("cut_bucket"),
                                       F.max("before").alias("before")))
    ranked = Window.partitionBy("s").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    upto, most = F.col("upto"), F.col("most")
    near = (placed.join(cut, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("cut_bucket")))
            .select(*cut.columns, "size", place().alias("place"))
            .withColumn("upto", F.col("before") + F.sum("size").over(ranked)))
    drawn = (upto - F.col("size") / 2 <= F.col("budget")) & (
        (upto <= most) | (upto - most < most - (upto - F.col("size")) - F.col("others")))
    return near.groupBy("s", "cut_bucket").agg(
        F.max(F.when(drawn, F.col("place"))).alias("last"),
        F.coalesce(F.max(F.when(drawn, upto)), F.max("before")).alias("spent"))


def repeated(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every document as often as it is taken, with the columns of ``docs``."""
    taken = mix(docs, carry=True, **options).where("copies > 0")
    return (taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
            .select(*[F.col("row")[c].alias(c) for c in docs.columns]))


#: The same rules in DuckDB: one window over every source instead of buckets.
ORACLE = r"""
with sized as (
  select doc_id, source,
    cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size,
    (cast('0x' || substr(md5('mix-1:' || coalesce(cast(doc_id as varchar), '')), 1, 13) as bigint)
     + 0.5e0) / 4503599627370496e0 as u from documents),
sums as (select source, sum(size)::bigint as source_size from sized group by source),
numbered as (select *, [5, 2, 1][cast((row_number() over (order by source nulls last) - 1) % 3 as int) + 1] as w,
    row_number() over (order by source nulls last) as n, 3 * source_size as cap from sums),
levelled as (select *, (sum(source_size) over () - coalesce(sum(cap) over (order by cap::double / w, n
      rows between unbounded preceding and 1 preceding), 0))::double
    / sum(w) over (order by cap::double / w, n rows between current row and unbounded following)::double as lev
  from numbered),
settled as (select *, cap <= w * lev as is_full,
    min(case when cap > w * lev then struct_pack(k := cap::double / w, n := n, lev := lev) end) over () as f from levelled),
targets as (select source, source_size, case when is_full then cap::double else w * f.lev end as target from settled),
per as (select *, case when source_size > 0 then floor(target / source_size) else 0 end as whole,
    target - case when source_size > 0 then floor(target / source_size) else 0 end * source_size as missing from targets),
ranked as (select d.*, p.source_size, p.target, p.whole, p.missing, d.size > p.missing * 0.02e0 as is_long,
    u / (1 - u) / sqrt(d.size::double) as r
  from sized d join per p on d.source is not distinct from p.source where d.size > 0),
longs as (select *, missing * sum(size) over (partition by source) / source_size as budget,
    source_size - sum(size) over (partition by source) as others,
    sum(size) over (partition by source order by r, doc_id, size rows between unbounded preceding and current row) as upto
  from ranked where is_long),
long_drawn as (select *, budget > 0 and upto - size / 2.0 <= budget
    and (upto <= missing or upto - missing < missing - (upto - size) - others) as drawn from longs),
spent as (select source, sum(size) as spent from long_drawn where drawn group by source),
shorts as (select k.*, k.missing - coalesce(s.spent, 0) as budget,
    sum(size) over (partition by k.source order by r, doc_id, size rows between unbounded preceding and current row) as upto
  from ranked k left join spent s on k.source is not distinct from s.source where not is_long),
everything as (
  select doc_id, source, size, source_size, target, whole + case when drawn then 1 else 0 end as copies from long_drawn
  union all
  select doc_id, source, size, source_size, target,
    whole + case when budget > 0 and upto - size / 2.0 <= budget then 1 else 0 end from shorts
  union all
  select d.doc_id, d.source, d.size, p.source_size, p.target, p.whole
  from sized d join per p on d.source is not distinct from p.source where d.size = 0)
select doc_id, source, size, source_size, target, cast(copies as bigint) as copies,
  cast(copies * size as bigint) as taken from everything
"""
