"""Intermediate tables.

Long plans are cut by writing a Parquet table into the shared folder the cluster names in
``spark.checkpoint.dir``. A table (unlike cached blocks) survives the loss of executors and
keeps column pruning for whoever reads it next.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def shuffles_deleted(spark: SparkSession):
    """Writes in here delete their shuffle files at their end, not when the driver next collects garbage."""
    return _setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def joined_where_dealt(spark: SparkSession):
    """Plans in here join rows that lie by ticker as they lie, also over more keys than the ticker.

    Spark would deal them once more by all keys, lest a ticker be too long: for layouts without long ones.
    """
    return _setting(spark, "spark.sql.requireAllClusterKeysForCoPartition", "false")


class Workspace:
    def __init__(self, spark: SparkSession):
        self.spark = spark
        root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
        if not root:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder all executors share")
            root = tempfile.mkdtemp(prefix="panelmend-")
            spark.conf.set("spark.checkpoint.dir", root)
        self.root = f"{root.rstrip('/')}/panelmend-{uuid.uuid4().hex}"
        self._buckets: list[str] = []

    def table(self, df: DataFrame, name: str, by: str | None = None) -> DataFrame:
        """Write ``df`` once and return a DataFrame that reads it back.

        With ``by`` rows lie in buckets of that column, as an exchange would deal them: windows and joins
        over it read the table without one.
        """
        path = f"{self.root}/{name}-{uuid.uuid4().hex[:8]}"
        if by is not None:
            return self._bucketed(df, path, by)
        with shuffles_deleted(self.spark):
            df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _bucketed(self, df: DataFrame, path: str, by: str) -> DataFrame:
        n, table = int(self.spark.conf.get("spark.sql.shuffle.partitions")), f"panelmend_{uuid.uuid4().hex}"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
        order = ", ".join(f"`{c}`" for c in (by, "seq") if c in df.columns)
        self.spark.sql(f"create table {table} ({columns}) using parquet options (compression 'zstd') clustered by (`{by}`) sorted by ({order}) "
                       f"into {n} buckets location '{path}'")
        self._buckets.append(table)
        with shuffles_deleted(self.spark), joined_where_dealt(self.spark):
            if not _lies_by(df, by, n):
                df = df.repartition(n, by)  # else every task would write to every bucket
            df.write.insertInto(table)
        return self.spark.table(table)

    def clear(self) -> None:
        """Delete this workspace's tables once nothing reads them any more."""
        for table in self._buckets:
            self.spark.sql(f"drop table {table}")
        self._buckets = []
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.root)
        fs = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        fs.delete(path, True)


def _lies_by(df: DataFrame, by: str, n: int) -> bool:
    """Whether the plan of ``df`` already deals its rows by this column to ``n`` partitions."""
    how = df._jdf.queryExecution().executedPlan().outputPartitioning().toString()
    return re.fullmatch(rf"hashpartitioning\({re.escape(by)}#\d+L?, {n}\)", how) is not None


def kept(df: DataFrame, name: str, workspace: Workspace | None) -> DataFrame:
    """``df`` written to the workspace when there is one, so that it is computed once."""
    return df if workspace is None else workspace.table(df, name)
