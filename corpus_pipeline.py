"""Corpus pipeline: toxicity, line deduplication, near-duplicates, mixing, packing.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame that the caller writes and
reads back as the next stage's docs. All but the last keep the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from arborframe.lineage import cut_lineage
from arborframe.llm import jaccard, linededup, mixing, packing
from arborframe.llm import toxicity as toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier does not reject."""
    return toxic.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that an earlier line repeats; n_chars follows the text."""
    return linededup.drop_repeated_lines(docs, min_words=1)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose five-word shingles have a similarity of 0.8 or more: SimHash links, verified, then what they miss."""
    return jaccard.keep_first(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources by weight: rows as often as they are taken."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The packed sequences, one row per piece."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", toxicity),
    ("line dedup", line_dedup),
    ("near-dedup", near_dedup),
    ("mixing sources", mix),
    ("best-fit packing", pack),
]

#: The toxicity model and the tokenizer are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the documents table, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
