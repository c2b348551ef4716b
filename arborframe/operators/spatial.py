"""Spatial joins as grid equi-joins.

Catalyst has no spatial join, and a distance condition alone would plan a nested
loop. Each row of the (smaller) right side is copied to the grid cells its search
ball touches; the left side keeps one cell per row, so the join is an ordinary
equi-join on (plot, cell). The left side is never multiplied before the join and a
crowded cell is an ordinary skewed key, which adaptive execution splits because no
later step relies on the join's partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arborframe.lineage import cut_lineage

XYZ = ("x", "y", "z")
XY = ("x", "y")


def cell(c: Column, size: float) -> Column:
    return F.floor(c / F.lit(float(size)))


def cells_around(coords: Sequence[str], radius: float, size: float) -> Column:
    """Array of the cells (``_c0``, ``_c1``, ..) that the box of ``radius`` around a row touches; null when a coordinate is.

    One generator for all coordinates: a chain of them, one per coordinate, lets the optimizer infer constraints through every
    alias of every coordinate, which takes minutes and the driver's memory where expressions on the pairs are long.
    """

    def further(i: int, known: list[Column]) -> Column:
        own = F.sequence(cell(F.col(coords[i]) - radius, size), cell(F.col(coords[i]) + radius, size))
        if i + 1 == len(coords):
            return F.transform(own, lambda c: F.struct(*[k.alias(f"_c{j}") for j, k in enumerate([*known, c])]))
        return F.flatten(F.transform(own, lambda c: further(i + 1, [*known, c])))

    return further(0, [])


def squared_distance(a: str | None, b: str, coords: Sequence[str]) -> Column:
    left = [F.col(f"{a}.{c}") if a else F.col(c) for c in coords]
    parts = [(p - F.col(f"{b}.{c}")) * (p - F.col(f"{b}.{c}")) for p, c in zip(left, coords)]
    return reduce(lambda p, q: p + q, parts)


def minkowski10(b: str, coords: Sequence[str]) -> Column:
    parts = [F.pow(F.abs(F.col(c) - F.col(f"{b}.{c}")), F.lit(10.0)) for c in coords]
    return F.pow(reduce(lambda p, q: p + q, parts), F.lit(0.1))


def radius_pairs(
    left: DataFrame,
    right: DataFrame,
    radius: float,
    coords: Sequence[str] = XYZ,
    by: Sequence[str] = ("plot_id",),
    metric: str = "euclid",
    inclusive: bool = True,
    size: float | None = None,
) -> DataFrame:
    """All (left row, right row) pairs within ``radius``.

    Output: the left columns, the right row as struct ``near`` and ``dist``.
    """
    size = size or radius
    by = list(by)
    keys = [f"_c{i}" for i in range(len(coords))]
    flat = right.select(*by, F.struct(*right.columns).alias("near"), F.explode(cells_around(coords, radius, size)).alias("_cell"))
    # Plan-time statistics see neither the copies nor rows a view explodes, so by them a join
    # would broadcast either side whatever its real size. The merge join passes no side through
    # the driver, and adaptive execution may split its exchanges when a cell is crowded.
    near = flat.select(*by, *[F.col(f"_cell.{k}").alias(k) for k in keys], "near")
    placed = left.select("*", *[cell(F.col(c), size).alias(k) for k, c in zip(keys, coords)])
    pairs = placed.join(near.hint("merge"), by + keys)
    if metric == "euclid":
        dist = F.sqrt(squared_distance(None, "near", coords))
    else:
        dist = minkowski10("near", coords)
    pairs = pairs.select(*left.columns, "near", dist.alias("dist"))
    return pairs.filter(F.col("dist") <= radius if inclusive else F.col("dist") < radius)


def one_per_position(df: DataFrame, coords: Sequence[str], by: Sequence[str], row_id: str, keep: int) -> DataFrame:
    """At most ``keep`` rows (lowest ids) per exact position.

    Exact for k-nearest work with k = keep, and it removes the quadratic cost of
    large groups of copies; the rank limit is applied before the shuffle too.
    """
    w = Window.partitionBy(*by, *coords).orderBy(row_id)
    return df.withColumn("_copy", F.row_number().over(w)).filter(F.col("_copy") <= keep).drop("_copy")


def knn_join(
    left: DataFrame,
    right: DataFrame,
    k: int,
    left_id: str,
    right_id: str,
    start_radius: float,
    coords: Sequence[str] = XYZ,
    by: Sequence[str] = ("plot_id",),
    exclude_self: bool = False,
    take: Sequence[str] = (),
    condition: str | None = None,
    need: str | None = None,
) -> DataFrame:
    """Exact k nearest right rows of every left row, ties by right id.

    Rows with fewer than k neighbours inside the searched ring go to the next round
    with a doubled radius. Output: by-columns, left id, near_id, near_dist, rank and
    ``take``. A left row gets fewer than k rows only if its group has fewer. With a
    ``condition`` on the pair (SQL over left columns and ``near``) the number of
    neighbours each left row can have is given by its column ``need``.
    """
    by = list(by)
    key = [*by, left_id]
    keep = k + 1 if exclude_self else k
    right = right.select(*dict.fromkeys([*by, right_id, *coords, *take]))
    if condition is None:
        right = one_per_position(right, coords, by, right_id, keep)
    right = cut_lineage(right)
    if need is None:
        own = 1 if exclude_self else 0
        sizes = right.groupBy(*by).agg(F.least(F.count(F.lit(1)) - own, F.lit(k)).cast("int").alias("_need"))
        pending = left.select(*key, *coords).join(sizes, by)
    else:
        pending = left.withColumn("_need", F.least(F.col(need), F.lit(k)).cast("int"))
    pending = cut_lineage(pending.filter("_need > 0"))
    w = Window.partitionBy(*key).orderBy("near_dist", "near_id")
    done: list[DataFrame] = []
    radius = start_radius
    while True:  # ends: the radius doubles until every needed row is inside
        pairs = radius_pairs(pending, right, radius, coords, by)
        if exclude_self:
            pairs = pairs.filter(F.col(left_id) != F.col(f"near.{right_id}"))
        if condition:
            pairs = pairs.filter(condition)
        ranked = (
            pairs.select(
                *key, "_need",
                F.col(f"near.{right_id}").alias("near_id"),
                F.col("dist").alias("near_dist"),
                *[F.col(f"near.{c}").alias(c) for c in take],
            )
            .withColumn("rank", F.row_number().over(w))
            .filter(F.col("rank") <= k)
        )
        ranked = cut_lineage(ranked)
        full = ranked.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"), F.first("_need").alias("_want")).filter("_n >= _want")
        done.append(ranked.join(full.select(*key), key, "left_semi").drop("_need"))
        pending = cut_lineage(pending.join(full.select(*key), key, "left_anti"))
        if pending.isEmpty():
            break
        radius *= 2.0
    return reduce(DataFrame.unionByName, done)
