"""Names of helper columns beside a whole table's own columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def spare(docs: DataFrame, *names: str) -> list[str]:
    """The names, each with as many leading underscores more as it takes to differ from every column of docs."""
    taken, out = {c.lower() for c in docs.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def own_columns(docs: DataFrame) -> list[Column]:
    """The columns of docs by name, also names that hold dots or backticks."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in docs.columns]
