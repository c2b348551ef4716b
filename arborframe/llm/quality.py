"""Document quality by votes of labelled neighbours in a latent semantic space.

A bounded sample of labelled texts spans the space: term weights (log count times inverse
document frequency) of selected features, reduced by the leading singular vectors. The
labelled vectors (at most 2 * ``per_class`` rows of ``dims`` numbers) are broadcast; every
document is projected and its cosine with every labelled vector is computed in blocks, and
the labels of the nearest ``neighbours`` vote with weights that grow with similarity. Class
weights undo the balanced sample, so votes follow the share of label 1 among all labels.

Defined results: a null, empty or blank text has no direction and gets the score 0.0; without
labels of both kinds every score is the share of label 1 (0.0 without labels); equal
similarities share the vote by position in a fixed order of the sample; every input row gives
one row. Only the text enters a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arborframe.llm.features import Vocabulary
from arborframe.llm.labelled import dense, feature_table, id_remainder, sample, vectors

#: Texts per class in the labelled sample; features and dimensions of the space.
PER_CLASS, FEATURES, DIMS = 2000, 1500, 48
NEIGHBOURS, SHARPNESS = 15, 8.0
HELD_OUT_MODULUS, HELD_OUT = 5, 0
THRESHOLD = 0.3
BLOCK = 1000


@dataclass
class Space:
    names: list[str]
    idf: np.ndarray
    basis: np.ndarray  # features x dims
    points: np.ndarray  # labelled vectors of length one
    labels: np.ndarray
    class_weight: np.ndarray
    share: float


def terms(x: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Weighted terms of length one; rows without terms stay zero."""
    t = np.log1p(x) * idf
    return t / np.maximum(np.linalg.norm(t, axis=1, keepdims=True), 1e-12)


def unit(v: np.ndarray) -> np.ndarray:
    n = np.linalg.norm(v, axis=1, keepdims=True)
    return np.where(n > 1e-9, v / np.maximum(n, 1e-9), 0.0).astype(np.float32)


def select_features(rows: DataFrame) -> list[str]:
    """The features whose presence differs most between the classes, in either direction."""
    sizes = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    a, b = sizes.get(1, 0) + 1.0, sizes.get(0, 0) + 1.0
    p, q = F.col("pos") / a, F.col("neg") / b
    pooled = (F.col("pos") + F.col("neg")) / (a + b)
    telling = F.abs(p - q) / F.sqrt(pooled * (1 - pooled) + 1e-4)
    found = feature_table(rows, prefixes=False).filter("feature <> 'n:words'").orderBy(F.desc(telling), "feature").limit(FEATURES)
    return [r["feature"] for r in found.select("feature").collect()]


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Space:
    """The space spanned by the labels given, which must not hold the held-out ids."""
    rows, share = sample(docs, labels, "quality", per_class)
    names = select_features(rows)
    x, y = vectors(rows, names)
    if not names or not 0 < y.sum() < len(y):
        return Space(names, np.ones(len(names)), np.zeros((len(names), 1)), np.zeros((0, 1), np.float32), np.zeros(0), np.zeros(0), share)
    idf = np.log((1 + len(x)) / (1 + (x > 0).sum(axis=0))) + 1.0
    t = terms(x, idf)
    _, basis = np.linalg.eigh(t.T @ t)
    basis = basis[:, ::-1][:, : min(DIMS, len(names))]
    weight = np.where(y > 0, share / y.mean(), (1 - share) / (1 - y.mean()))
    return Space(names, idf, basis, unit(t @ basis), y, weight, share)


def vote(space: Space, x: np.ndarray, neighbours: int = NEIGHBOURS) -> np.ndarray:
    """Scores of documents given as counts of the space's features."""
    if not len(space.points):
        return np.full(len(x), space.share)
    v = unit(terms(x, space.idf) @ space.basis)
    out = np.zeros(len(x))
    for at in range(0, len(x), BLOCK):
        cosine = v[at : at + BLOCK] @ space.points.T
        k = min(neighbours, cosine.shape[1])
        near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        say = np.maximum(np.take_along_axis(cosine, near, axis=1), 0.0).astype(float) ** SHARPNESS * space.class_weight[near]
        total = say.sum(axis=1)
        out[at : at + BLOCK] = np.where(total > 0, (say * space.labels[near]).sum(axis=1) / np.where(total > 0, total, 1), 0.0)
    return np.clip(out, 0.0, 1.0)


def score(docs: DataFrame, space: Space, column: str = "score") -> DataFrame:
    """docs with the score of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(space))  # bounded by the sample and the space

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        space = Space(**shared.value)
        vocabulary = Vocabulary(space.names)
        for texts in batches:
            parts = [vote(space, dense(texts.iloc[at : at + BLOCK], vocabulary)) for at in range(0, len(texts), BLOCK)]
            yield pd.Series(np.concatenate(parts) if parts else np.zeros(0))

    return docs.withColumn(column, scored(F.col("text")))


def training_labels(labels: DataFrame) -> DataFrame:
    return labels.filter(id_remainder(F.col("doc_id"), HELD_OUT_MODULUS) != HELD_OUT)


def quality(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of docs."""
    scored = score(docs.select("doc_id", "text"), fit(docs, training_labels(labels), per_class))
    held = id_remainder(F.col("doc_id"), HELD_OUT_MODULUS) == HELD_OUT
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
