"""The registered queries of this package: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession

from arborframe.llm import capfilter, editprint, linededup, mixing, packing, prefixtrie, quality, repair, sentencepieces, simhash, sqltext, toxicity, warc, wrapper

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrapper.extract(table(spark, sf_dir, "pages"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken_words(table(spark, sf_dir, "documents"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.page_records(warc.round_trip(table(spark, sf_dir, "pages")))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = linededup.drop_repeated_lines(table(spark, sf_dir, "documents"), min_words=1, counted=True)
    return cleaned.select("doc_id", "text", "n_lines", "n_dropped")


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return capfilter.near_duplicates(table(spark, sf_dir, "embeddings"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return editprint.with_next(table(spark, sf_dir, "documents"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixtrie.shared_head_trie(table(spark, sf_dir, "conversations"))


def op12_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair_report(table(spark, sf_dir, "conversations"))


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepieces.round_trip(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_html_extraction": op1_html_extraction,
    "op2_toxicity": op2_toxicity,
    "op3_mixing": op3_mixing,
    "op4_simhash": op4_simhash,
    "op5_warc": op5_warc,
    "op6_line_dedup": op6_line_dedup,
    "op7_embedding_dedup": op7_embedding_dedup,
    "op8_quality": op8_quality,
    "op9_fingerprints": op9_fingerprints,
    "op10_packing": op10_packing,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_structure_repair": op12_structure_repair,
    "op13_sentencepiece": op13_sentencepiece,
    "pipeline": corpus_pipeline.run,
}

ORACLE: dict[str, str] = {"op3_mixing": sqltext.MIXING, "op5_warc": sqltext.WARC, "op11_prefix_trie": sqltext.PREFIX_TRIE}
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
