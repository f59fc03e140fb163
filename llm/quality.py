"""Quality classifier: labelled latent-semantic vectors are broadcast; every document is compared with all of them.

Hashed counts of words and word shapes of a bounded sample of labelled documents are weighted by rarity and reduced by a
singular value decomposition. Each document's vector is multiplied with all labelled vectors in blocks (exact cosines),
and its nearest neighbours vote with their similarity as weight.

Nulls, empty texts and texts without words have the zero vector, to which no neighbour is similar: their score is the share
of good documents among the sampled ones with a zero vector, each class weighing as it does among all labels that may be
learnt from, and that share of all labels if there is none. Repeated rows get equal scores; very long texts are counted
whole, piece by piece. Without labelled rows every score is the prior given. Extra columns pass through or are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm.features import counts, width
from llm.frames import fresh, map_texts
from llm.labelled import held_out, sample


@dataclass(frozen=True)
class Neighbours:
    """rows: labelled documents per class that are kept, which bounds the broadcast (rows x 2 x dims floats)."""

    rows: int = 1500
    words: int = 1024
    shapes: int = 1024
    dims: int = 64
    nearest: int = 25
    sharpness: float = 4.0
    prior: float = 0.5
    threshold: float = 0.3


@dataclass
class Model:
    idf: np.ndarray
    basis: np.ndarray
    vectors: np.ndarray
    good: np.ndarray
    none: float = 0.5  # score of the zero vector

    def vote(self, x: np.ndarray, p: Neighbours) -> np.ndarray:
        """Scores of rows of counts; all cosines of a block of rows with all labelled vectors are computed."""
        if not len(self.good):
            return np.full(len(x), self.none)
        v = _unit((x * self.idf) @ self.basis)
        cosine = v @ self.vectors.T
        k = min(p.nearest, cosine.shape[1])
        top = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        weight = np.clip(np.take_along_axis(cosine, top, 1), 0, 1).astype(np.float64) ** p.sharpness
        total = weight.sum(1)
        score = (weight * self.good[top]).sum(1) / np.where(total > 0, total, 1)
        return np.clip(np.where(total > 1e-12, score, self.none), 0, 1)


def _unit(v: np.ndarray) -> np.ndarray:
    norm = np.sqrt((v * v).sum(1, keepdims=True))
    return v / np.where(norm > 1e-9, norm, 1)


def fit(docs: DataFrame, labels: DataFrame, p: Neighbours = Neighbours()) -> Model:
    """Learn from labelled documents that are not held out."""
    quality = F.when(F.col("quality").isin(0, 1), F.col("quality"))
    wide = width(p.words, p.shapes)

    def encode(texts):
        return [row.tobytes() for row in counts(texts, p.words, p.shapes).astype(np.float16)]

    got = sample(docs, labels, quality, p.rows, encode, ~held_out(F.col("doc_id")))
    x = np.empty((len(got), wide), np.float32)
    for i, (f, _) in enumerate(got):
        x[i] = np.frombuffer(f, np.float16)
    y = np.array([y for _, y in got], np.int64)
    if not len(y):
        return Model(np.ones(wide, np.float32), np.zeros((wide, 1), np.float32), np.zeros((0, 1), np.float32), y, p.prior)
    idf = np.log((1 + len(y)) / (1 + (x > 0).sum(0))).astype(np.float32) + 0.1
    x *= idf
    learnt = labels.where(quality.isNotNull() & ~held_out(F.col("doc_id"))).groupBy(quality.cast("int").alias("y")).count()
    known = dict(learnt.collect())  # two rows at most
    basis = _leading(x, min(p.dims, len(y)))
    empty = ~(x != 0).any(1)
    return Model(idf, basis, _unit(x @ basis), y.astype(np.float64), _share(y[empty], y, known))


def _share(some: np.ndarray, sampled: np.ndarray, labels: dict[int, int]) -> float:
    """Share of 1 in `some` of the sampled classes, each sampled row standing for as many labels of its class."""
    stands = {c: n / max(1, int((sampled == c).sum())) for c, n in labels.items()}
    weight = {c: stands[c] * (int((some == c).sum()) if len(some) else int((sampled == c).sum())) for c in labels}
    total = sum(weight.values())
    return weight.get(1, 0.0) / total if total else 0.5


def _leading(x: np.ndarray, dims: int, more: int = 16, rounds: int = 8) -> np.ndarray:
    """The leading right singular vectors of x by subspace iteration, in little memory beside x."""
    basis = np.random.default_rng(1).normal(size=(x.shape[1], min(dims + more, *x.shape))).astype(np.float32)
    for _ in range(rounds):
        basis = np.linalg.qr(x.T @ (x @ basis))[0]
    small = x @ basis
    turn = np.linalg.svd(small.T @ small)[0]
    return np.ascontiguousarray((basis @ turn)[:, :dims], dtype=np.float32)


def score(docs: DataFrame, model: Model, p: Neighbours, keep: list[str], name: str = "score") -> DataFrame:
    """Columns `keep` of docs and the score of each text."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def fn(batch, texts):
        return [sent.value.vote(counts(texts, p.words, p.shapes), p)]

    return map_texts(docs, fn, [T.StructField(name, T.DoubleType())], keep)


def classify(docs: DataFrame, labels: DataFrame, p: Neighbours = Neighbours()) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of docs."""
    out = score(docs, fit(docs, labels, p), p, ["doc_id"])
    return out.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= p.threshold).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, p: Neighbours = Neighbours()) -> DataFrame:
    """The rows of docs, columns unchanged, whose score reaches the threshold."""
    name = fresh(docs, "score")
    out = score(docs, fit(docs, labels, p), p, docs.columns, name)
    return out.where(F.col(name) >= p.threshold).select(*[f"`{c}`" for c in docs.columns])
