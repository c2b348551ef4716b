"""Named queries over the driver tables, each with its check text where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from arborframe import fixtures

Query = Callable[[SparkSession, str], DataFrame]


class Views:
    """Lazy access to the fixture views of one scale folder."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return fixtures.view(self.spark, self.sf_dir, f"fx_{name}")


QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Callable[[Views], DataFrame]], Callable[[Views], DataFrame]]:
    def add(build: Callable[[Views], DataFrame]) -> Callable[[Views], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"duplicate query name {name}")
        QUERIES[name] = lambda spark, sf_dir: build(Views(spark, sf_dir))
        if sql is not None:
            ORACLE[name] = sql
        return build

    return add
