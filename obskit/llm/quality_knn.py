"""Quality classifier: nearest-neighbour voting in a latent-semantic space.

Labelled rows, at most ``sample`` of each label, give a term matrix; its leading right singular vectors project
texts to short unit vectors. The labelled vectors are broadcast (bounded: 2 x sample x rank numbers), each document
has its exact cosine with every one of them, in blocks, and its nearest ``k`` vote, weighted by similarity and by
how frequent their label is among all labelled rows.

Defined cases: a null text counts as empty and is scored; repeated rows score alike; without labelled rows every
score is 0.5, with one label only every score is that label; labels other than 0 and 1 and other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import row_type, rows_with_text
from .features import each_block, inverse_frequency, labelled_sample, sample_terms, weigh


@dataclass
class NeighbourModel:
    idf: np.ndarray
    basis: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    weights: np.ndarray
    k: int = 32

    def project(self, x: np.ndarray) -> np.ndarray:
        z = weigh(x, self.idf) @ self.basis
        return z / np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-9)

    def score(self, x: np.ndarray) -> np.ndarray:
        if not len(self.labels):
            return np.full(len(x), 0.5)
        near = self.project(x) @ self.vectors.T
        k = min(self.k, near.shape[1])
        top = np.argpartition(-near, k - 1, axis=1)[:, :k]
        votes = np.exp(20 * (np.take_along_axis(near, top, axis=1).astype(np.float64) - 1)) * self.weights[top]
        return (votes * self.labels[top]).sum(axis=1) / votes.sum(axis=1)


def fit(docs: DataFrame, labels: DataFrame, label: str, allowed: Column, sample: int = 1500, rank: int = 48) -> NeighbourModel:
    """Fit on at most ``sample`` rows of each label among the ``allowed`` ones."""
    x, y = sample_terms(labelled_sample(docs, labels, label, sample, allowed, (0, 1)))
    if not len(y):
        empty = np.zeros((0, rank), dtype=np.float32)
        return NeighbourModel(inverse_frequency(x), empty, empty, y, np.zeros(0))
    shares = {r["label"]: r["n"] for r in labels.filter(F.col(label).isin(0, 1) & allowed).groupBy(F.col(label).alias("label")).agg(F.count("*").alias("n")).collect()}
    weights = np.array([shares.get(v, 1) / max(1, (y == v).sum()) for v in y.tolist()], dtype=np.float64)
    idf = inverse_frequency(x)
    w = weigh(x, idf)
    values, vectors = np.linalg.eigh((w.T @ w).astype(np.float64))
    basis = vectors[:, np.argsort(values)[::-1][: min(rank, len(y))]].astype(np.float32)
    model = NeighbourModel(idf, basis, np.zeros(0), y, weights / weights.max())
    model.vectors = model.project(x)
    return model


def score(docs: DataFrame, model: NeighbourModel, keep: list[str] | None = None) -> DataFrame:
    """(row, score) of every row: ``keep`` (all columns, if None) as a struct, and the weighted share of label 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for rows, x, _ in each_block(batches):
            yield pa.RecordBatch.from_arrays([rows.column("row"), pa.array(m.score(x), pa.float64())], names=["row", "score"])

    rows = rows_with_text(docs, keep)
    return rows.mapInArrow(each, f"{row_type(rows)}, score double")
