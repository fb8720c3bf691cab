"""What several of these operators share: scratch tables, word rules, connected components."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelmend.workspace import Workspace

#: One word: anything but space, tab, newline, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def table(df_dir: str, name: str) -> str:
    return f"{df_dir}/{name}.parquet"


def n_words(text: Column) -> Column:
    """Number of words; 0 for null and empty texts."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


#: Bytes of an Arrow batch; Spark's default of 64 MB lets a worker hold several hundred MB of texts.
BATCH_BYTES = 4 << 20
_BATCH_SETTING, _BATCH_DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"


def small_batches(spark: SparkSession) -> None:
    """Bounds the Arrow batches of this session where it has Spark's default.

    Batches decide about no row, only about what a worker holds at once.
    """
    if spark.conf.get(_BATCH_SETTING) == _BATCH_DEFAULT:
        spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))


class Scratch(Workspace):
    """A workspace whose tables can be dropped one by one while a loop runs.

    Tables live in the shared folder, so they outlive executors.
    """

    def __init__(self, spark: SparkSession):
        super().__init__(spark)
        small_batches(spark)

    def save(self, df: DataFrame, name: str) -> tuple[DataFrame, str]:
        path = f"{self.root}/{name}-{uuid.uuid4().hex[:8]}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path), path

    def drop(self, path: str) -> None:
        jvm = self.spark.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def connected_components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``(id, component_id)`` for every end of an edge; the component is its smallest id.

    ``edges``: columns ``a``, ``b`` of one orderable type, nulls not allowed. Alternates the large
    and the small star of Kiveris et al. (2014) until the edges no longer change. Every step is a
    minimum (combined before its shuffle) and a join with one row per node, so a node with very
    many neighbours is never gathered: Spark splits its rows in the join.
    """
    now = (edges.where("a <> b")
           .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    now, path = scratch.save(now, "edges")
    mark = None
    while True:
        at = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if at == mark:
            return now.select(F.col("u").alias("id"), F.col("v").alias("component_id")).union(
                now.select("v", "v").distinct())
        mark = at
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = (both.where("v > u").join(least, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        large, large_path = scratch.save(large, "large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").where("v <> m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(least.select("u", "m")).distinct())
        new, new_path = scratch.save(small, "small")
        scratch.drop(path)
        scratch.drop(large_path)
        now, path = new, new_path


#: Bits of the filter of maybe_among; 8 MB, whatever the number of ids.
FILTER_BITS = 1 << 26


def maybe_among(ids: DataFrame) -> Callable[[Column], Column]:
    """A test whether an id may be among ``ids``: true for all that are, and few others.

    A bitmap of fixed size takes the place of a semi join that would shuffle a wide side. With
    very many ids it only lets more rows pass; whoever joins afterwards gets the same result.
    """
    import zlib

    import numpy as np
    import pyarrow as pa
    from pyspark.sql import types as T

    pieces = 64
    width = FILTER_BITS // pieces

    def places(values: np.ndarray) -> np.ndarray:
        x = values.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return ((x ^ (x >> np.uint64(29))) % np.uint64(FILTER_BITS)).astype(np.int64)

    def marked(batches):
        bits = np.zeros((pieces, width // 8), dtype=np.uint8)
        for batch in batches:
            at = np.unique(places(batch.column(0).to_numpy()))
            for i in np.unique(at // width):
                one = np.zeros(width, dtype=bool)
                one[at[at // width == i] - i * width] = True
                bits[i] |= np.packbits(one)
        rows = [(i, zlib.compress(x.tobytes(), 1)) for i, x in enumerate(bits) if x.any()]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()),
                                          pa.array([r[1] for r in rows], pa.binary())],
                                         names=["piece", "bits"])

    def merged(batches):
        out: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                new = np.frombuffer(zlib.decompress(data), dtype=np.uint8)
                out[i] = out[i] | new if i in out else new
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(out), pa.int32()), pa.array([x.tobytes() for x in out.values()],
                                                       pa.binary())], names=["piece", "bits"])

    kind = "piece int, bits binary"
    bits = np.zeros((pieces, width // 8), dtype=np.uint8)
    for row in (ids.where(ids.columns[0] + " is not null").mapInArrow(marked, kind)
                .repartition(pieces, "piece").mapInArrow(merged, kind).collect()):
        bits[row["piece"]] = np.frombuffer(row["bits"], dtype=np.uint8)
    shared = ids.sparkSession.sparkContext.broadcast(bits.reshape(-1))

    def among(values: pd.Series) -> pd.Series:
        at = places(values.to_numpy())
        return pd.Series((shared.value[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1)

    test = F.pandas_udf(among, T.BooleanType())
    return lambda column: column.isNotNull() & test(F.coalesce(column.cast("long"), F.lit(0)))
