"""Toxicity scores by weak supervision.

1. Many voters look at a text: lexicon voters (disjoint word and prefix lists mined from the
   labelled sample, and one fixed list of insults) and pattern voters (shouting, exclamation,
   repetition). Each says toxic, clean or nothing.
2. A generative label model estimates by EM how often each voter is right, with the given
   label as one more (fallible) voter, and how far voters are correlated given the class; the
   say of correlated voters is divided among them.
3. A linear classifier is trained on the posterior labels and scores every whole text.

Defined results: a null, empty or blank text has no features and gets the score of the bias
alone (low); without any usable label the fixed list alone decides; every input row gives one
row; ties do not arise. Only the text enters a score.
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
from arborframe.llm.names import own_columns, spare

#: Common insults, the voter that needs no label.
INSULTS = ("idiot", "moron", "stupid", "loser", "scum", "trash", "worthless", "pathetic", "disgusting", "clown")
#: Texts per class in the training sample.
PER_CLASS = 3000
#: Mined lexicon entries.
LEXICON = 1200
LEXICON_VOTERS = 12
HELD_OUT_MODULUS, HELD_OUT = 3, 1
THRESHOLD = 0.7


@dataclass
class ToxicityModel:
    names: list[str]
    log_odds: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    accuracies: np.ndarray
    correlations: np.ndarray


def mine_lexicon(rows: DataFrame) -> tuple[list[str], np.ndarray]:
    """The features most telling for label 1, with their log-odds in the sample."""
    table = feature_table(rows)
    sizes = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    a, b = sizes.get(1, 0) + 1.0, sizes.get(0, 0) + 1.0
    odds = F.log((F.col("pos") + 0.5) / a) - F.log((F.col("neg") + 0.5) / b)
    # the lower bound of the log-odds, so that chance finds in a small sample stay out
    odds = odds - 1.64 * F.sqrt(1 / (F.col("pos") + 0.5) + 1 / (F.col("neg") + 0.5))
    top = table.filter("feature like 'w:%' or feature like 'p:%'").withColumn("odds", odds).filter("odds > 0.5")
    top = top.orderBy(F.desc(F.col("odds") * F.sqrt("pos")), "feature").limit(LEXICON).toPandas()
    names, values = list(top["feature"]), list(top["odds"])
    for word in INSULTS:
        if f"w:{word}" not in names:
            names.append(f"w:{word}")
            values.append(3.0)
    extra = ["s:A!!", "s:a!", "r:word", "n:words"]
    return names + extra, np.array(values + [0.0] * len(extra))


def votes(x: np.ndarray, names: list[str], log_odds: np.ndarray) -> np.ndarray:
    """One column per voter: 1 toxic, -1 clean, 0 no opinion."""
    hit, words = x > 0, np.maximum(x[:, names.index("n:words")], 1)
    kinds = np.array([{"w": 0, "p": 1}.get(n[0], -1) for n in names])
    out = []
    for v in range(LEXICON_VOTERS):
        own = np.flatnonzero((kinds == v % 2) & (np.arange(len(names)) // 2 % (LEXICON_VOTERS // 2) == v // 2))
        found = hit[:, own] @ log_odds[own]
        out.append(np.where(found >= 2, 1, np.where(found <= 0, -1, 0)))
    fixed = hit[:, [names.index(f"w:{w}") for w in INSULTS]].sum(axis=1)
    out.append(np.where(fixed >= 1, 1, 0))
    for name, level in (("s:A!!", 0.3), ("s:a!", 0.02), ("r:word", 0.3)):
        rate = x[:, names.index(name)] / words
        out.append(np.where(rate >= level, 1, np.where(rate == 0, -1, 0)))
    return np.stack(out, axis=1).astype(int)


def label_model(ballots: np.ndarray, prior: float, rounds: int = 30) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(posterior, accuracies, correlations) of ballots in {-1, 0, 1}; the last column, the given
    label, starts the estimates. Accuracy: share of a voter's opinions that fit the posterior."""
    n, voters = ballots.shape
    if n == 0:
        return np.zeros(0), np.full(voters, 0.5), np.eye(voters)
    one_hot = np.stack([ballots == v for v in (-1, 0, 1)], axis=2).astype(float)
    post = np.where(ballots[:, -1] > 0, 0.9, np.where(ballots[:, -1] < 0, 0.1, prior))
    share, corr = np.ones(voters), np.eye(voters)
    centred = ballots - ballots.mean(axis=0)
    for k in range(rounds):
        table = np.stack([np.einsum("i,ivk->vk", w, one_hot) + 1.0 for w in (1 - post, post)])
        table /= table.sum(axis=2, keepdims=True)
        # correlation of voters given the class, over what the class means leave unexplained
        rest = ballots - ((1 - post)[:, None] * (table[0] @ [-1, 0, 1]) + post[:, None] * (table[1] @ [-1, 0, 1]))
        sd = np.sqrt((rest**2).mean(axis=0)) + 1e-6
        corr = (rest.T @ rest) / n / np.outer(sd, sd)
        if k == rounds // 2:  # from the settled independent model; discounting earlier would feed on its own doubt
            share = 1.0 / (1.0 + np.maximum(corr - np.eye(voters), 0).sum(axis=1))
            share[-1] = 1.0
        evidence = np.einsum("ivk,vk->iv", one_hot, np.log(table[1]) - np.log(table[0])) @ share
        post = 1 / (1 + np.exp(-np.clip(evidence + np.log(prior / (1 - prior)), -30, 30)))
    said = (ballots != 0) & (centred != 0)
    right = np.where(ballots > 0, post[:, None], 1 - post[:, None])
    return post, (right * said).sum(axis=0) / np.maximum(said.sum(axis=0), 1), corr


def inputs(x: np.ndarray, names: list[str], log_odds: np.ndarray) -> np.ndarray:
    """Inputs of the linear classifier: presence of each lexicon entry, and summed evidence
    alone and against the length of the text."""
    words = np.maximum(x[:, names.index("n:words")], 1)[:, None]
    hit = (x[:, : len(names) - 4] > 0).astype(np.float32)
    kinds = np.array([n[0] for n in names[:-4]])
    sums = np.stack([hit @ np.where(kinds == k, log_odds[:-4], 0) for k in "wp"] + [hit @ (kinds == k) for k in "wp"], axis=1)
    rates = np.stack([x[:, :-4] @ np.where(kinds == k, log_odds[:-4], 0) for k in "wp"], axis=1) / words
    return np.concatenate([hit, np.log1p(sums), np.log1p(20 * rates), sums / np.sqrt(words)], axis=1)


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float, rounds: int = 400) -> tuple[np.ndarray, float]:
    """Weights and bias of an L2 penalised logistic regression on soft labels (accelerated gradient)."""
    z = np.concatenate([x, np.ones((len(x), 1))], axis=1).astype(np.float64)
    ridge = np.full(z.shape[1], penalty)
    ridge[-1] = 0
    v = np.ones(z.shape[1])
    for _ in range(20):
        v = z.T @ (weight * (z @ v))
        v /= np.linalg.norm(v) + 1e-12
    step = 1 / (0.25 * float(v @ (z.T @ (weight * (z @ v)))) + penalty)
    w = last = np.zeros(z.shape[1])
    for k in range(rounds):
        ahead = w + k / (k + 3) * (w - last)
        p = 1 / (1 + np.exp(-np.clip(z @ ahead, -30, 30)))
        last, w = w, ahead - step * (z.T @ (weight * (p - y)) + ridge * ahead)
    return w[:-1], float(w[-1])


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> ToxicityModel:
    """Fit on the labels given, which must not hold the held-out ids."""
    rows, share = sample(docs, labels, "toxic", per_class)
    names, log_odds = mine_lexicon(rows)
    x, y = vectors(rows, names)
    prior = min(max(share, 0.01), 0.99)
    ballots = np.concatenate([votes(x, names, log_odds), np.where(y > 0, 1, -1)[:, None]], axis=1) if len(x) else np.zeros((0, LEXICON_VOTERS + 5), int)
    post, accuracies, correlations = label_model(ballots, prior)
    if 0 < y.sum() < len(y):
        feats = inputs(x, names, log_odds)
        scale = 1 / (feats.std(axis=0) + 0.05)
        weight = np.where(y > 0, share * len(y) / y.sum(), (1 - share) * len(y) / (len(y) - y.sum()))
        weights, bias = logistic(feats * scale, post, weight, penalty=max(0.1, len(y) / 2000))
    else:  # no labels of both kinds: the fixed list decides
        scale = np.ones(len(names) - 4 + 10)
        weights, bias = np.zeros(len(scale)), -3.0
        weights[[names.index(f"w:{w}") for w in INSULTS]] = 2.5
    return ToxicityModel(names, log_odds, scale, weights, bias, accuracies, correlations)


def score(docs: DataFrame, model: ToxicityModel, column: str = "score") -> DataFrame:
    """docs with the score of every whole text."""

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        vocabulary = Vocabulary(model.names)
        for texts in batches:
            out = np.zeros(len(texts))
            for at in range(0, len(texts), 1000):
                feats = inputs(dense(texts.iloc[at : at + 1000], vocabulary), model.names, model.log_odds)
                out[at : at + 1000] = 1 / (1 + np.exp(-np.clip((feats * model.scale) @ model.weights + model.bias, -30, 30)))
            yield pd.Series(out)

    return docs.withColumn(column, scored(F.col("text")))


def training_labels(labels: DataFrame) -> DataFrame:
    return labels.filter(id_remainder(F.col("doc_id"), HELD_OUT_MODULUS) != HELD_OUT)


def toxicity(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of docs."""
    scored = score(docs.select("doc_id", "text"), fit(docs, training_labels(labels), per_class))
    held = id_remainder(F.col("doc_id"), HELD_OUT_MODULUS) == HELD_OUT
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """The rows of docs scored below the threshold, with their columns as they were."""
    model = fit(docs, training_labels(labels), per_class)
    (found,) = spare(docs, "_toxicity")
    return score(docs, model, found).filter(F.col(found) < THRESHOLD).select(*own_columns(docs))
