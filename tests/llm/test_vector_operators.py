"""Neighbours and near-duplicates of vectors, components, the pipeline."""

import numpy as np
import pytest

from panelmend.llm import forest, neighbours
from panelmend.llm.common import Scratch, connected_components, maybe_among
from pyspark.sql import functions as F

KIND = "vec_id long, embedding array<float>, label int, n_links string"


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((40, 24))
    x = np.concatenate([c + 0.12 * rng.standard_normal((15, 24)) for c in centres])
    rows = [(i, v.tolist(), int(i % 3) if i % 50 else None, "x") for i, v in enumerate(x)]
    rows += [(600 + i, x[0].tolist(), 0, "x") for i in range(30)] + [(700, (2 * x[1]).tolist(), 1, "x")]
    rows += [(800, None, 1, "x"), (801, [0.0] * 24, 1, "x"), (802, [float("nan")] + [1.0] * 23, 1, "x"),
             (803, [None] + [1.0] * 23, 1, "x"), (804, [float("inf")] * 24, 1, "x"), (805, [], 1, "x"),
             (806, [1.0, 2.0], 1, "x"), (807, [1.0, 2.1], 1, "x"), (900, [1.0, 2.0], 1, "x")]
    return spark.createDataFrame(rows, KIND).repartition(3)


def usable(rows):
    return [(r.vec_id, np.array(r.embedding, dtype=float), r.label) for r in rows
            if r.embedding and None not in r.embedding and np.isfinite(r.embedding).all()
            and np.any(r.embedding)]


def test_forest_finds_every_link(vectors):
    got = {r.vec_id: r for r in forest.near_duplicates(vectors, leaf_rows=24).collect()}
    assert len(got) == vectors.count()
    rows = [r for r in usable(vectors.collect()) if r[2] is not None]
    links, root = {}, {i: i for i in got}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a, p in rows:
        for j, b, q in rows:
            if i != j and p == q and len(a) == len(b) and a @ b / np.sqrt((a @ a) * (b @ b)) >= 0.93:
                links[i] = links.get(i, 0) + 1
                root[max(find(i), find(j))] = min(find(i), find(j))
    for i, r in got.items():
        assert (r.n_links, r.component_id, r.kept) == (links.get(i, 0), find(i), find(i) == i), i
    assert forest.near_duplicates(vectors.limit(0)).count() == 0


def test_neighbours(spark, vectors):
    rows = vectors.where(neighbours.usable(F.col("embedding"))).select(
        "vec_id", F.col("embedding").alias("vector"))
    index = Scratch(spark).table(neighbours.index(rows, shard_rows=150), "index")
    queries = rows.where("vec_id % 20 = 0").withColumnRenamed("vec_id", "query_id")
    found = {}
    for r in neighbours.search(queries, index, query_block=9).collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    known = usable(vectors.collect())
    hits = total = 0
    for i, a, _ in known:
        if i % 20:
            continue
        best = sorted((float(np.sqrt(((a - b) ** 2).sum())), j) for j, b, _ in known
                      if j != i and len(a) == len(b))[:10]
        got = sorted(found[i])
        assert [n for n, _, _ in got] == list(range(1, len(best) + 1))
        assert [(s, j) for _, j, s in got] == sorted((s, j) for _, j, s in got)
        hits += len({j for _, j in best} & {j for _, j, _ in got})
        total += len(best)
    assert hits / total >= 0.95
    assert neighbours.search(queries, neighbours.index(rows.limit(0))).count() == 0


def test_components(spark):
    rng = np.random.default_rng(4)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 400, (260, 2))] + [(i, i + 1) for i in range(500, 560)]
    edges += [(1000, i) for i in range(1001, 1100)]
    root = {x: x for e in edges for x in e}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in edges:
        root[max(find(a), find(b))] = min(find(a), find(b))
    got = connected_components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark))
    got = {r["id"]: r.component_id for r in got.collect()}
    assert got == {i: find(i) for a, b in edges if a != b for i in (a, b)}


def test_maybe_among(spark):
    ids = spark.range(0, 3000, 3)
    rows = spark.range(3000).withColumn("id", F.when(F.col("id") > 5, F.col("id")))
    kept = {r.id for r in rows.where(maybe_among(ids)(F.col("id"))).collect()}
    assert {i for i in range(6, 3000, 3)} <= kept and len(kept) < 1100 and None not in kept


def test_pipeline(spark):
    import corpus_pipeline
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = Scratch(spark).table(stage(spark, docs, sf_dir), "stage")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert 0 < docs.count()
    got = corpus_pipeline.run(spark, sf_dir)
    assert got.count() == corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).count()


def nearest_by_hand(rows, k=10):
    """Every query id's k nearest other ids, from all pairs of rows, in exact fractions."""
    from fractions import Fraction

    out = []
    queries = sorted({i for i, _ in rows if i % 100 == 0})
    for q in queries:
        best = {}
        for i, v in rows:
            if i != q:
                for j, w in rows:
                    if j == q and len(v) == len(w):
                        d = sum((Fraction(a) - Fraction(b)) ** 2 for a, b in zip(v, w))
                        best[i] = min(d, best.get(i, d))
        out += [(q, r + 1, i, d) for r, (i, d) in enumerate(sorted(best.items(), key=lambda x: (x[1], x[0]))[:k])]
    return out


@pytest.mark.parametrize("scale", [1.0, 2.0 ** 665])
def test_repeated_ids_ties_and_huge_components(spark, scale):
    rng = np.random.default_rng(4)
    rows = [(i, (scale * rng.integers(-4, 5, 6)).tolist()) for i in range(1, 330)]
    rows += [(100, rows[3][1]), (100, rows[3][1]), (100, rows[8][1])]  # equal and different rows of a query id
    rows += [(7, rows[50][1]), (7, rows[3][1]), (8, rows[3][1])] + [(9, (scale * rng.normal(size=6)).tolist()) for _ in range(40)]
    df = spark.createDataFrame(rows, "vec_id long, vector array<double>").repartition(3)
    got = neighbours.search(df.where("vec_id % 100 = 0").withColumnRenamed("vec_id", "query_id"),
                            neighbours.index(df, shard_rows=120))
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got.collect())
    want = nearest_by_hand(rows)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    for g, w in zip(got, want):
        assert g[3] / scale == pytest.approx(float(w[3] / int(scale) ** 2) ** 0.5, rel=1e-12)
