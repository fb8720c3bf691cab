"""Embedding near-duplicates by a forest of random-projection trees.

Equal vectors of one label become one node. Every tree splits each (label, dimension) recursively:
a cell is halved at the median of its vectors' projections on a random direction, and whoever lies
close to the cut goes into both halves (spill). The distance to the cut within which vectors spill
is fixed by the radius of the links, not by the cell, so tight groups are not torn apart. Cells that
are small, or that no longer shrink, are leaves. Within leaves all pairs are compared in double
precision; a large leaf is compared block against block, each in a task of its own.

No pairs leave a leaf: it emits one count per vector and at most one edge per vector of a spanning
forest. A pair that meets in several leaves is counted in the first of them only, which each leaf
decides from the lists of leaves its vectors are in.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components, and rows
without label, link with nothing and are kept; vectors of different length are never compared;
repeated ids are separate rows; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelmend.llm.common import Scratch, connected_components
from panelmend.llm.neighbours import usable

TREES = 6
LEAF_ROWS = 256
BLOCK_ROWS = 512
#: Spill on either side of a cut, as part of the distance at which vectors just link.
SPILL = 0.45
#: A cell that kept more than this part of its parent's vectors is not split further.
STALLED = 0.8
MAX_LEVELS = 48
SEED = 11


def directions(dim: int, levels: int, trees: int, seed: int = SEED) -> np.ndarray:
    """A random direction for every tree and level, side by side."""
    return np.random.default_rng((seed, dim)).standard_normal((dim, trees * levels))


def _unit(vectors: pd.Series) -> np.ndarray:
    x = np.stack(vectors.to_numpy()).astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)  # no overflow, no underflow
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def nodes_of(vectors: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """``(rows, nodes)``: rows ``vec_id, node`` and nodes ``node, label, vector, copies, first``."""
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), "label",
        F.col("embedding").cast("array<double>").alias("vector"))
    fit = usable(F.col("vector")) & F.col("label").isNotNull()
    nodes = (rows.where(fit).groupBy("label", "vector")
             .agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("first"))
             .withColumn("node", F.monotonically_increasing_id()))
    nodes = scratch.table(nodes, "nodes")
    # a copy never leaves its label and vector, so only these two are compared
    named = rows.join(nodes.select("label", "vector", "node"), ["label", "vector"], "left")
    return named.select("vec_id", "node"), nodes


def leaves(nodes: DataFrame, radius: float, scratch: Scratch, trees: int = TREES,
           leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """``node, label, dim, cell, n``: the leaves of every node, numbered within label and dim."""
    largest = nodes.groupBy("label", F.size("vector")).count().agg(F.max("count")).first()[0] or 0
    levels = min(MAX_LEVELS, 4 + math.ceil(math.log2(max(1, largest / leaf_rows)) * 1.5))
    spill = SPILL * radius

    def projected(vectors: pd.Series) -> pd.Series:
        out = np.empty(len(vectors), dtype=object)
        dims = vectors.map(len).to_numpy()
        for dim in np.unique(dims):
            at = np.flatnonzero(dims == dim)
            p = _unit(vectors.iloc[at]) @ directions(int(dim), levels, trees)
            for i, x in zip(at, p.astype(np.float32)):
                out[i] = x.reshape(trees, levels)
        return pd.Series([list(x) for x in out])

    project = F.pandas_udf(projected, T.ArrayType(T.ArrayType(T.FloatType())))
    active = (nodes.select("node", "label", F.size("vector").alias("dim"),
                           project("vector").alias("p"))
              .select("node", "label", "dim", F.posexplode("p").alias("tree", "p"))
              .withColumn("path", F.lit(1).cast("long")).withColumn("parent", F.lit(2 ** 62)))
    active, path = scratch.save(active, "cells")
    cell = ["label", "dim", "tree", "path"]
    found: list[DataFrame] = []
    for level in range(MAX_LEVELS):
        at = F.col("p")[level % levels]
        mids = active.groupBy(*cell).agg(F.count(F.lit(1)).alias("n"),
                                         F.percentile_approx(at, 0.5, 1000).alias("mid"))
        sized = active.join(mids, cell)
        last = level == MAX_LEVELS - 1
        done = (F.col("n") <= leaf_rows) | (F.col("n") > F.col("parent") * STALLED) | F.lit(last)
        sides = F.filter(F.array(F.when(at < F.col("mid") + spill, F.col("path") * 2),
                                 F.when(at >= F.col("mid") - spill, F.col("path") * 2 + 1)),
                         lambda x: x.isNotNull())
        step, step_path = scratch.save(
            sized.withColumn("done", done)
            .withColumn("path", F.explode(F.when(F.col("done"), F.array("path")).otherwise(sides)))
            .select("node", "label", "dim", "tree", "path", "p", F.col("n").alias("parent"), "done"),
            "cells")
        number = (F.col("tree").cast("long") * F.lit(2 ** 52)) + F.col("path")
        found.append(step.where("done").select("node", "label", "dim", number.alias("cell"),
                                               F.col("parent").alias("n")))
        active = step.where("not done").drop("done")
        if level == 0:
            scratch.drop(path)
        if active.isEmpty():
            break
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out


OUT = T.StructType([T.StructField(c, T.LongType()) for c in ("a", "b", "links")])


def linked(leaf: DataFrame, nodes: DataFrame, least: float, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Rows ``(a, null, links)``, part of a node's number of links, and edges ``(a, b, null)``."""
    listed = leaf.groupBy("node").agg(F.collect_list(F.struct("cell", "n")).alias("in"))
    units = nodes.join(listed, "node").select(
        "node", "label", F.size("vector").alias("dim"), "copies", "vector",
        F.transform("in", lambda x: x["cell"]).alias("cells"), F.explode("in").alias("x"))
    blocks = F.ceil(F.col("x.n") / block_rows)
    dealt = (units.withColumn("cell", F.col("x.cell")).withColumn("blocks", blocks)
             .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .withColumn("lo", F.least("block", "other")).withColumn("hi", F.greatest("block", "other")))

    def compare(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        cell, lo, hi = key[2], key[3], key[4]
        if len(rows) < 2:
            return pd.DataFrame({c: [] for c in OUT.names}, dtype="Int64")
        x = _unit(rows["vector"])
        near = x @ x.T >= least
        np.fill_diagonal(near, False)
        if lo != hi:
            block = rows["block"].to_numpy()
            near &= block[:, None] != block[None, :]
        some = np.flatnonzero(near.any(axis=1))
        near = near[np.ix_(some, some)]
        if len(some):
            cells = rows["cells"].iloc[some]
            owner = np.repeat(np.arange(len(some)), cells.map(len).to_numpy())
            ids = np.concatenate(cells.to_numpy())
            before = ids < cell
            seen, at = np.unique(ids[before], return_inverse=True)
            member = np.zeros((len(some), len(seen)), dtype=np.float32)
            member[owner[before], at] = 1
            near &= member @ member.T == 0  # counted in an earlier leaf
        node = rows["node"].to_numpy()[some]
        links = near @ rows["copies"].to_numpy()[some]
        label = np.arange(len(some))
        while len(some):
            new = np.minimum(label, np.where(near, label[None, :], len(some)).min(axis=1))
            new = new[new]
            if (new == label).all():
                break
            label = new
        a = np.flatnonzero(links > 0)
        e = np.flatnonzero(label != np.arange(len(some)))
        return pd.DataFrame({
            "a": pd.array([*node[a], *node[e]], dtype="Int64"),
            "b": pd.array([*[pd.NA] * len(a), *node[label[e]]], dtype="Int64"),
            "links": pd.array([*links[a], *[pd.NA] * len(e)], dtype="Int64")})

    return dealt.select("label", "dim", "cell", "lo", "hi", "node", "copies", "vector", "cells",
                        "block").groupBy("label", "dim", "cell", "lo", "hi").applyInPandas(compare, OUT)


def near_duplicates(vectors: DataFrame, least: float = 0.93, trees: int = TREES,
                    leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """Per row ``vec_id, n_links, component_id, kept``; links: same label, cosine >= ``least``."""
    scratch = Scratch(vectors.sparkSession)
    rows, nodes = nodes_of(vectors, scratch)
    radius = math.sqrt(max(0.0, 2 - 2 * least))
    found = scratch.table(linked(leaves(nodes, radius, scratch, trees, leaf_rows), nodes, least),
                          "linked")
    links = found.where("links is not null").groupBy(F.col("a").alias("node")).agg(
        F.sum("links").alias("links"))
    groups = connected_components(found.where("b is not null").select("a", "b"), scratch)
    of = (nodes.select("node", "copies", "first").join(links, "node", "left")
          .join(groups.withColumnRenamed("id", "node"), "node", "left")
          .withColumn("component", F.coalesce("component_id", "node"))
          .select("node", "first", "component",
                  (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")))
    of = scratch.table(of, "of_node")
    least_id = of.groupBy("component").agg(F.min("first").alias("least"))
    of = of.join(least_id, "component").select("node", "n_links", "least")
    component = F.coalesce("least", "vec_id")
    return rows.join(of, "node", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"))
