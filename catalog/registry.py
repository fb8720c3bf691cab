"""Every registered query with, where SQL can say the same, its DuckDB counterpart."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return add


def cte(*parts: str) -> str:
    """``with`` clause from CTE texts."""
    return "with " + ",".join(p.strip() for p in parts) + "\n"


def snap(c, digits: int = 6):
    """Cut a computed double to a grid whose edges are no round numbers.

    Two engines may differ in the last bit; plain rounding would turn that into a visible
    difference at ties, which planted powers of two hit often.
    """
    return F.floor(c * float(10 ** digits) + 0.3) / float(10 ** digits)


def snap_sql(expr: str, digits: int = 6) -> str:
    return f"floor(({expr}) * 1e{digits} + 0.3e0) / 1e{digits}"
