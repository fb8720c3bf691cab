"""Approximate nearest neighbours: one navigable small-world graph per shard.

Vectors are dealt to shards of bounded size by a hash of their id. Each shard builds a hierarchical
graph (Malkov and Yashunin 2016) over its distinct vectors and stores it as one row of flat arrays:
vectors, ids, and per level the neighbours of every node in one padded array. Every block of queries
visits every shard; the shards' results are merged by distance.

Equal vectors share one node that lists all their ids, so a very common vector neither crowds a
graph nor hides anything: of one node, only the ``k + 1`` smallest ids can be among the ``k``
nearest.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components take no
part, nor do rows without an id; vectors of different lengths are never compared; ids may repeat, with
equal or with different vectors: a query id has one list, which names each vec_id once, with the
smallest distance between any row of one and any row of the other, and leaves out every row of its own
id; ties go to the smaller id; with fewer candidates than asked, all are returned; very large components
are scaled by a power of two, so distances stay finite wherever a double can hold them; empty tables
give an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHARD_ROWS = 2_500
QUERY_BLOCK = 2_000
NEIGHBOURS = 12  # per node above the ground level; twice as many on it
BUILD_WIDTH = 60
SEARCH_WIDTH = 80
#: Most partitions that shards, or pairs of shard and query block, are spread over.
MAX_PARTITIONS = 20_000


def usable(vector: Column) -> Column:
    """Whether a vector takes part."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~odd & F.exists(vector, lambda x: x != 0), F.lit(False))


class Graph:
    """A small-world graph over distinct vectors, built in memory for one shard."""

    def __init__(self, vectors: np.ndarray, links: list[np.ndarray], top: int, scale: float = 1.0):
        #: as they are divided by ``scale``
        self.vectors, self.links, self.top, self.scale = vectors, links, top, scale

    @classmethod
    def build(cls, vectors: np.ndarray, m: int = NEIGHBOURS, width: int = BUILD_WIDTH) -> Graph:
        n = len(vectors)
        rng = np.random.default_rng(n)
        heights = np.minimum((-np.log(1 - rng.random(n)) / np.log(m)).astype(int), 12)
        links = [np.full((n, 2 * m if level == 0 else m), -1, dtype=np.int32)
                 for level in range(int(heights.max(initial=0)) + 1)]
        graph = cls(vectors, links, 0)
        highest = int(heights[0]) if n else 0
        for i in range(1, n):
            query, start = vectors[i], [(graph._far(vectors[i], [graph.top])[0], graph.top)]
            for level in range(highest, -1, -1):
                if level > heights[i]:
                    start = graph._search(query, start, level, 1)
                    continue
                start = graph._search(query, start, level, width)
                for other in graph._spread(start, m):
                    graph._link(i, other, level)
                    graph._link(other, i, level)
            if heights[i] > highest:
                highest, graph.top = int(heights[i]), i
        return graph

    def _far(self, query: np.ndarray, nodes) -> np.ndarray:
        diff = self.vectors[nodes] - query
        return np.einsum("ij,ij->i", diff, diff)

    def _search(self, query, start, level: int, width: int) -> list[tuple[float, int]]:
        """The nearest nodes of one level, nearest first; start has (distance, node)."""
        links = self.links[level]
        seen = {node for _, node in start}
        open_, best = list(start), [(-d, node) for d, node in start]
        heapq.heapify(open_)
        heapq.heapify(best)
        while open_:
            d, node = heapq.heappop(open_)
            if d > -best[0][0] and len(best) >= width:
                break
            new = [x for x in links[node].tolist() if x >= 0 and x not in seen]
            if not new:
                continue
            seen.update(new)
            for far, x in zip(self._far(query, new).tolist(), new):
                if len(best) < width:
                    heapq.heappush(best, (-far, x))
                    heapq.heappush(open_, (far, x))
                elif far < -best[0][0]:
                    heapq.heapreplace(best, (-far, x))
                    heapq.heappush(open_, (far, x))
        return sorted((-d, node) for d, node in best)

    def _spread(self, near: list[tuple[float, int]], m: int) -> list[int]:
        """Of near nodes those that are nearer to the new one than to each other; then the rest."""
        if len(near) <= m:
            return [node for _, node in near]
        nodes = [node for _, node in near]
        vectors = self.vectors[nodes]
        squares = np.einsum("ij,ij->i", vectors, vectors)
        between = squares[:, None] + squares[None, :] - 2 * (vectors @ vectors.T)
        own = np.array([d for d, _ in near])
        free, chosen = np.ones(len(nodes), dtype=bool), []
        for j in range(len(nodes)):
            if free[j]:
                chosen.append(j)
                if len(chosen) == m:
                    break
                free &= between[j] >= own
                free[j] = False
        rest = [j for j in range(len(nodes)) if j not in set(chosen)]
        return [nodes[j] for j in (chosen + rest)[:m]]

    def _link(self, node: int, to: int, level: int) -> None:
        row = self.links[level][node]
        empty = np.flatnonzero(row < 0)
        if len(empty):
            row[empty[0]] = to
            return
        nodes = [*row.tolist(), to]
        far = self._far(self.vectors[node], nodes)
        near = sorted(zip(far.tolist(), nodes))
        row[:] = self._spread(near, len(row))

    def nearest(self, query: np.ndarray, k: int, width: int = SEARCH_WIDTH) -> list[int]:
        """Nodes near a query; all of them where there are hardly more than asked for."""
        n = len(self.vectors)
        if n <= max(width, k):
            return list(range(n))
        start = [(self._far(query, [self.top])[0], self.top)]
        for level in range(len(self.links) - 1, 0, -1):
            start = self._search(query, start, level, 1)
        found = [node for _, node in self._search(query, start, 0, max(width, k))]
        return found if len(found) >= k else list(range(n))


INDEX = ("dim int, shard long, vectors binary, ids binary, id_ends binary, links array<binary>, "
         "top long")


def build_shard(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """One index row for all vectors of a shard."""
    vectors = np.stack([np.asarray(v, dtype=np.float64) for v in rows["vector"]])
    ids = rows["vec_id"].to_numpy(np.int64)
    distinct, at = np.unique(vectors, axis=0, return_inverse=True)
    at = at.reshape(-1)
    order = np.lexsort((ids, at))
    shuffled = np.random.default_rng(len(distinct)).permutation(len(distinct))
    place = np.empty_like(shuffled)
    place[shuffled] = np.arange(len(shuffled))
    order = order[np.argsort(place[at[order]], kind="stable")]
    ends = np.cumsum(np.bincount(place[at], minlength=len(distinct)))
    scale = _scale(distinct)
    graph = Graph.build(distinct[shuffled] / scale)
    return pd.DataFrame([{
        "dim": key[0], "shard": key[1], "vectors": distinct[shuffled].tobytes(),
        "ids": ids[order].tobytes(), "id_ends": ends.astype(np.int64).tobytes(),
        "links": [x.tobytes() for x in graph.links], "top": graph.top}])


def load_shard(row) -> tuple[Graph, np.ndarray, np.ndarray]:
    vectors = np.frombuffer(row["vectors"], dtype=np.float64).reshape(-1, row["dim"])
    links = [np.frombuffer(x, dtype=np.int32).reshape(len(vectors), -1) for x in row["links"]]
    scale = _scale(vectors)
    return (Graph(vectors / scale, links, int(row["top"]), scale), np.frombuffer(row["ids"], dtype=np.int64),
            np.frombuffer(row["id_ends"], dtype=np.int64))


FOUND = "query_id long, vec_id long, score double"
#: Components beyond this are scaled down before they are squared.
LARGE = 2.0 ** 400


def _scale(vectors: np.ndarray) -> float:
    """A power of two that brings large components down to 1; 1 for all others."""
    most = float(np.abs(vectors).max(initial=0.0))
    return 1.0 if most < LARGE else 2.0 ** float(np.frexp(most)[1])


def _near_ids(graph: Graph, ids: np.ndarray, ends: np.ndarray, query_id: int, query: np.ndarray, k: int,
              width: int) -> list[tuple[int, float]]:
    """The k nearest other ids with their distances; more nodes are asked for while ids repeat."""
    scale, asked = max(graph.scale, _scale(query)), k + 1
    down, same = query / scale, graph.scale / scale
    while True:
        nodes = graph.nearest(query / graph.scale, asked, max(width, asked))
        diff = graph.vectors[nodes] * same - down
        far = np.sqrt((diff * diff).sum(axis=1)) * scale
        best: dict[int, float] = {}
        for node, score in sorted(zip(nodes, far.tolist()), key=lambda x: x[1]):
            first = int(ends[node - 1]) if node else 0
            own = ids[first:int(ends[node])]  # sorted
            taken = 0
            for x in own.tolist():
                if x != query_id and x not in best:
                    best[x] = score
                    taken += 1
                    if taken == k:
                        break
        if len(best) >= k or len(nodes) >= len(graph.vectors):
            return sorted(best.items(), key=lambda x: (x[1], x[0]))[:k]
        asked *= 2


def _spread_out(df: DataFrame, units: int, *keys: str) -> DataFrame:
    """Few groups to a partition: their bytes are few but their work is not.

    Left to itself, adaptive execution merges partitions by bytes and builds many graphs in one
    task. Four partitions to a group keep groups that hash alike apart.
    """
    return df.repartition(min(MAX_PARTITIONS, max(1, 4 * units)), *keys)


def index(vectors: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The shards' graphs over ``vec_id, vector``, one row each."""
    sizes = vectors.groupBy(F.size("vector").alias("dim")).agg(
        F.ceil(F.count(F.lit(1)) / shard_rows).alias("shards"))
    dealt = (vectors.withColumn("dim", F.size("vector")).join(sizes, "dim")
             .withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.col("shards"))))
    units = sizes.agg(F.sum("shards")).first()[0] or 1
    dealt = _spread_out(dealt.select("dim", "shard", "vec_id", "vector"), units, "dim", "shard")
    return dealt.groupBy("dim", "shard").applyInPandas(build_shard, INDEX)


def search(queries: DataFrame, indexed: DataFrame, k: int = 10, width: int = SEARCH_WIDTH,
           query_block: int = QUERY_BLOCK) -> DataFrame:
    """``query_id, rank, vec_id, score`` for queries ``query_id, vector``.

    Both sides are copied by arithmetic on block and shard numbers only: a task holds one shard and
    one bounded block of queries. The work is the number of queries times the number of shards.
    """
    blocks = queries.groupBy(F.size("vector").alias("dim")).agg(
        F.ceil(F.count(F.lit(1)) / query_block).alias("blocks"))
    shards = indexed.groupBy("dim").agg((F.max("shard") + 1).alias("shards"))
    sides = blocks.join(shards, "dim")
    dealt = (queries.distinct().withColumn("dim", F.size("vector")).join(sides, "dim")
             .withColumn("block", F.pmod(F.xxhash64("query_id"), F.col("blocks")))
             .withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))
             .select("dim", "shard", "block", "query_id", "vector"))
    graphs = (indexed.join(sides.select("dim", "blocks"), "dim")
              .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .drop("blocks"))

    def visit(key: tuple, asked: pd.DataFrame, shard: pd.DataFrame) -> pd.DataFrame:
        out = []
        for row in shard.to_dict("records"):
            graph, ids, ends = load_shard(row)
            for query_id, vector in zip(asked["query_id"], asked["vector"]):
                query = np.asarray(vector, dtype=np.float64)
                out += [(query_id, x, score) for x, score in _near_ids(
                    graph, ids, ends, query_id, query, k, width)]
        best = pd.DataFrame(out, columns=["query_id", "vec_id", "score"])
        return (best.sort_values(["query_id", "score", "vec_id"]).drop_duplicates(["query_id", "vec_id"])
                .groupby("query_id").head(k)
                .astype({"query_id": "int64", "vec_id": "int64", "score": "float64"}))

    units = sides.agg(F.sum(F.col("blocks") * F.col("shards"))).first()[0] or 1
    key = ["dim", "shard", "block"]
    found = (_spread_out(dealt, units, *key).groupBy(*key)
             .cogroup(_spread_out(graphs, units, *key).groupBy(*key)).applyInPandas(visit, FOUND))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    found = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
