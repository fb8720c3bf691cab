"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages of 48 words. Every passage is encoded by shape (kinds of
characters, lengths and repetition of words) and by hashed words, then by a learned layer. Gated
attention (Ilse et al. 2018) weighs the passages; the weighted mean is scored. Encoder, attention
and score are learned together from document labels by gradient descent in numpy.

Fitting uses a bounded, documented sample: at most ``SAMPLE_DOCS`` labelled documents, those with
the smallest hash of their id, and at most ``SAMPLE_PASSAGES`` evenly spaced passages of each.
Scoring reads every passage of every text. Labels, language, source and ids are never inputs.

Defined cases: null, empty and blank texts are bags without passages, scored by the bias alone;
labels that are null, not 0 or 1, or contradict each other for one id are not learned from; repeated
rows are scored alike; without any labels every score is 0.5; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelmend.llm.common import Scratch
from panelmend.llm.shingles import slices, words

PASSAGE_WORDS = 48
SAMPLE_DOCS = 6_000
SAMPLE_PASSAGES = 64
HASHED = 64
HIDDEN, ATTENTION = 32, 16
STEPS, BATCH, RATE, DECAY = 700, 256, 0.01, 1e-4

_KINDS = np.zeros((8, 256), dtype=np.float32)
for _i, _chars in enumerate((range(65, 91), range(97, 123), range(48, 58), b"!?", b".,;:",
                             b"\"'()[]{}<>", b"\n", range(128, 256))):
    _KINDS[_i, list(_chars)] = 1
FEATURES = len(_KINDS) + 6 + HASHED


def encode(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features of every passage, and the offsets of the texts' passages."""
    hashes, at = words(data, offsets)
    counts = np.diff(at)
    passages = -(-counts // PASSAGE_WORDS)
    ends = np.concatenate([[0], np.cumsum(passages)])
    n = int(ends[-1])
    if not n:
        return np.zeros((0, FEATURES), np.float32), ends
    nth = np.arange(len(hashes)) - np.repeat(at[:-1], counts)
    passage = np.repeat(ends[:-1], counts) + nth // PASSAGE_WORDS
    # bytes of a passage: from its first word to the next passage's
    solid = ~np.isin(data, np.array([32, 9, 10, 11, 12, 13], dtype=np.uint8))
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    first[inner] = solid[inner]
    starts = np.flatnonzero(first)
    head = np.append(True, passage[1:] != passage[:-1])
    begin = starts[head]
    size = np.diff(np.append(begin, len(data))).astype(np.float32)
    out = np.zeros((n, FEATURES), dtype=np.float32)
    for i, kind in enumerate(_KINDS):
        out[:, i] = np.sqrt(np.add.reduceat(kind[data], begin) / size)
    k = len(_KINDS)
    per = np.bincount(passage, minlength=n).astype(np.float32)
    letters = np.add.reduceat(solid.astype(np.float32), begin)
    out[:, k] = np.log1p(letters / per)
    length = np.add.reduceat(solid.astype(np.float32), starts)
    out[:, k + 1] = np.log1p(np.sqrt(np.maximum(
        np.bincount(passage, length ** 2, n) / per - (letters / per) ** 2, 0)))
    order = np.lexsort((hashes, passage))
    new = np.append(True, (hashes[order][1:] != hashes[order][:-1])
                    | (passage[order][1:] != passage[order][:-1]))
    out[:, k + 2] = np.bincount(passage[order], new, n) / per
    out[:, k + 3] = np.log1p(per)
    out[:, k + 4] = np.log1p(np.repeat(counts, passages))
    doc = np.repeat(np.arange(len(counts)), counts)
    order = np.lexsort((hashes, doc))
    new = np.append(True, (hashes[order][1:] != hashes[order][:-1])
                    | (doc[order][1:] != doc[order][:-1]))
    whole = np.bincount(doc[order], new, len(counts)) / np.maximum(counts, 1)
    out[:, k + 5] = np.repeat(whole, passages)
    bag = np.bincount(passage * HASHED + (hashes % np.uint64(HASHED)).astype(np.int64),
                      minlength=n * HASHED).reshape(n, HASHED)
    out[:, k + 6:] = np.sqrt(bag / per[:, None])
    return out, ends


def _softmax(x: np.ndarray, begin: np.ndarray, owner: np.ndarray) -> np.ndarray:
    e = np.exp(x - np.maximum.reduceat(x, begin)[owner])
    return e / np.add.reduceat(e, begin)[owner]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


class Model:
    """Weights, as plain arrays of fixed size."""

    def __init__(self, weights: dict[str, np.ndarray]):
        self.w = weights

    @classmethod
    def fresh(cls, rng: np.random.Generator) -> Model:
        def normal(*shape):
            return rng.standard_normal(shape) / np.sqrt(shape[0])
        return cls({"mean": np.zeros(FEATURES), "scale": np.ones(FEATURES),
                    "E": normal(FEATURES, HIDDEN), "e": np.zeros(HIDDEN),
                    "V": normal(HIDDEN, ATTENTION), "U": normal(HIDDEN, ATTENTION),
                    "a": normal(ATTENTION), "c": np.zeros(HIDDEN), "b": np.zeros(1)})

    def forward(self, x: np.ndarray, begin: np.ndarray, owner: np.ndarray) -> dict[str, np.ndarray]:
        w = self.w
        x = (x - w["mean"]) * w["scale"]
        h = np.tanh(x @ w["E"] + w["e"])
        v, u = np.tanh(h @ w["V"]), _sigmoid(h @ w["U"])
        alpha = _softmax((v * u) @ w["a"], begin, owner)
        z = np.add.reduceat(alpha[:, None] * h, begin)
        return {"x": x, "h": h, "v": v, "u": u, "alpha": alpha, "z": z, "y": z @ w["c"] + w["b"][0]}

    def scores(self, x: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """One score per bag; bags without passages get the bias."""
        sizes = np.diff(ends)
        out = np.full(len(sizes), self.w["b"][0])
        some = np.flatnonzero(sizes)
        if len(some):
            out[some] = self.forward(x, ends[:-1][some], np.repeat(np.arange(len(some)), sizes[some]))["y"]
        return _sigmoid(out)

    def gradients(self, x, begin, owner, labels) -> dict[str, np.ndarray]:
        w, f = self.w, self.forward(x, begin, owner)
        dy = (_sigmoid(f["y"]) - labels) / len(labels)
        dz = dy[:, None] * w["c"]
        d_alpha = (dz[owner] * f["h"]).sum(axis=1)
        ds = f["alpha"] * (d_alpha - np.add.reduceat(f["alpha"] * d_alpha, begin)[owner])
        dv = ds[:, None] * w["a"] * f["u"] * (1 - f["v"] ** 2)
        du = ds[:, None] * w["a"] * f["v"] * f["u"] * (1 - f["u"])
        dh = f["alpha"][:, None] * dz[owner] + dv @ w["V"].T + du @ w["U"].T
        dp = dh * (1 - f["h"] ** 2)
        return {"E": f["x"].T @ dp, "e": dp.sum(axis=0), "V": f["h"].T @ dv, "U": f["h"].T @ du,
                "a": ((f["v"] * f["u"]) * ds[:, None]).sum(axis=0), "c": f["z"].T @ dy,
                "b": np.array([dy.sum()])}


def fit(bags: list[np.ndarray], labels: np.ndarray, seed: int = 5) -> Model:
    """Adam on the log loss of bags of passages."""
    rng = np.random.default_rng(seed)
    model = Model.fresh(rng)
    keep = [i for i, b in enumerate(bags) if len(b)]
    if not keep:
        return model
    bags, labels = [bags[i] for i in keep], labels[keep]
    every = np.concatenate(bags).astype(np.float64)
    model.w["mean"], spread = every.mean(axis=0), every.std(axis=0)
    model.w["scale"] = np.where(spread > 1e-6, 1 / np.maximum(spread, 1e-6), 0)
    rate = np.clip(labels.mean(), 0.01, 0.99)
    model.w["b"][0] = np.log(rate / (1 - rate))
    first = {k: 0.0 for k in ("E", "e", "V", "U", "a", "c", "b")}
    second = dict(first)
    for step in range(1, STEPS + 1):
        pick = rng.integers(0, len(bags), min(BATCH, 4 * len(bags)))
        sizes = np.array([len(bags[i]) for i in pick])
        begin = np.cumsum(sizes) - sizes
        grads = model.gradients(np.concatenate([bags[i] for i in pick]), begin,
                                np.repeat(np.arange(len(pick)), sizes), labels[pick])
        pace = RATE * min(1, 2 * (1 - step / (STEPS + 1)))
        for k, g in grads.items():
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            move = first[k] / (1 - 0.9 ** step) / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
            model.w[k] = model.w[k] - pace * (move + DECAY * model.w[k] * (k not in "eb"))
    return model


def held_out(doc_id: Column) -> Column:
    """The third of the ids that is never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Model:
    """A model of ``quality`` from the labelled documents outside the held-out third."""
    known = (labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()
                          & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("most"))
             .where("quality = most")
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs).select("doc_id", "quality"))
    known = Scratch(docs.sparkSession).table(known, "sample")

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in slices(batch.column(2)):
                x, ends = encode(data, offsets)
                rows = []
                for i in range(hi - lo):
                    size = int(ends[i + 1] - ends[i])
                    at = ends[i] + (np.arange(size) if size <= SAMPLE_PASSAGES else
                                    np.linspace(0, size - 1, SAMPLE_PASSAGES).astype(int))
                    rows.append(x[at].tobytes())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo),
                     pa.array(rows, pa.binary())], names=["doc_id", "quality", "bag"])

    # at most sample_docs ids, so this side may be broadcast
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .join(F.broadcast(known), "doc_id").groupBy("doc_id")
            .agg(F.first("quality").alias("quality"), F.min("text").alias("text"))
            .select("doc_id", F.col("quality").cast("int").alias("quality"), "text")
            .mapInArrow(bags, "doc_id long, quality int, bag binary").collect())
    rows.sort(key=lambda r: r["doc_id"])
    return fit([np.frombuffer(r["bag"], np.float32).reshape(-1, FEATURES) for r in rows],
               np.array([r["quality"] for r in rows], dtype=np.float64))


def score_column(model: Model, text: Column) -> Column:
    """The score of every whole text."""
    import pandas as pd
    from pyspark.sql import types as T

    weights = model.w

    def score(texts):
        own, out = Model(weights), []
        for _, _, data, offsets in slices(pa.array(texts, pa.large_string(), from_pandas=True)):
            out.append(own.scores(*encode(data, offsets)))
        return pd.Series(np.concatenate(out) if out else np.zeros(0))

    score.__annotations__ = {"texts": pd.Series, "return": pd.Series}
    return F.pandas_udf(score, T.DoubleType())(text)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every document."""
    model = train(docs, labels)
    return (docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"),
                        score_column(model, F.col("text")).alias("score"))
            .withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0)))
