"""Bounded samples of labelled documents, on which the document classifiers are fitted.

``per_class`` is the documented bound: the labelled rows of each class with the smallest
hash of doc_id, at most that many. Everything a classifier then scores is the whole table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arborframe.lineage import cut_lineage
from arborframe.llm.features import Vocabulary, counts


def id_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus``; -1 for a null id."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(modulus)), F.lit(-1)).cast("int")


def sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int) -> tuple[DataFrame, float]:
    """(rows(text, label), share): the bounded sample and the share of label 1 among all labelled ids.

    Ids labelled twice count as 1 when any label is 1; rows that repeat an id count once.
    """
    known = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    known = cut_lineage(known)
    share = known.agg(F.avg("label")).first()[0]
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = known.filter("label = 1").orderBy(*order).limit(per_class).unionByName(known.filter("label = 0").orderBy(*order).limit(per_class))
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.first("label").alias("label"))
    return cut_lineage(rows.select("text", "label")), float(share or 0.0)


def feature_table(rows: DataFrame, prefixes: bool = True, least: int = 3) -> DataFrame:
    """(feature, pos, neg): in how many sampled texts of each class a feature occurs."""

    def spell(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for text, y in zip(batch["text"], batch["label"]):
                names = list(counts(text, prefixes))
                if names:
                    yield pd.DataFrame({"feature": names, "pos": int(y), "neg": 1 - int(y)})

    found = rows.mapInPandas(spell, "feature string, pos long, neg long")
    return found.groupBy("feature").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).filter(F.col("pos") + F.col("neg") >= least)


def vectors(rows: DataFrame, names: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(counts, labels) of the bounded sample as arrays on the driver, in a fixed order."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vocabulary = Vocabulary(names)
        for batch in batches:
            found = [vocabulary.vector(t) for t in batch["text"]]
            yield pd.DataFrame({"label": batch["label"], "ids": [list(v) for v in found], "n": [list(v.values()) for v in found]})

    got = rows.mapInPandas(count, "label int, ids array<int>, n array<int>").toPandas()
    x = np.zeros((len(got), len(names)), dtype=np.float32)
    for i, (ids, n) in enumerate(zip(got["ids"], got["n"])):
        x[i, np.asarray(ids, dtype=int)] = n
    y = got["label"].to_numpy(dtype=np.float64)
    order = np.lexsort([*x[:, ::-1].T[-32:], x.sum(axis=1), y])
    return x[order], y[order]


def dense(texts: pd.Series, vocabulary: Vocabulary) -> np.ndarray:
    x = np.zeros((len(texts), len(vocabulary.names)), dtype=np.float32)
    for i, text in enumerate(texts):
        found = vocabulary.vector(text)
        x[i, list(found)] = list(found.values())
    return x
