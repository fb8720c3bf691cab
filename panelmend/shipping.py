"""Puts the library on the Python path of the executors."""

from __future__ import annotations

import functools
import os
import tempfile
import zipfile
from collections.abc import Callable

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@functools.cache
def _zipped() -> str:
    path = os.path.join(tempfile.mkdtemp(prefix="panelmend-"), "panelmend.zip")
    with zipfile.ZipFile(path, "w") as out:
        for top in ("panelmend", "catalog"):
            for folder, _, files in os.walk(os.path.join(HERE, top)):
                for name in files:
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        out.write(full, os.path.relpath(full, HERE))
        for name in os.listdir(HERE):
            if name.endswith(".py"):
                out.write(os.path.join(HERE, name), name)
    return path


_sent: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends the package's sources to the workers of this session, once per application."""
    context: SparkContext = spark.sparkContext
    if context.applicationId not in _sent:
        context.addPyFile(_zipped())
        _sent.add(context.applicationId)


def shipped(query: Callable[[SparkSession, str], DataFrame]):
    """The query, with the package sent first."""
    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)
    return run
