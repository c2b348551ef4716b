"""Field inventories, VR exports and reconciliation with detected trees."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arborframe.functions import forestry as forest
from arborframe.functions import geometry as geo
from arborframe.lineage import cut_lineage
from arborframe.operators.measure import ranked_by_bearing
from arborframe.operators.spatial import XY, radius_pairs

FIELD_COLUMNS = ("plot_id", "tree_id", "x_tree_bh", "y_tree_bh", "z_tree_bh", "distance", "bearing", "dbh", "cci_at_bh", "height", "review")


def field_to_trees(field: DataFrame, dbh_height: float = 1.4) -> DataFrame:
    """Field rows as tree rows; a missing height falls back to the previous one (Review 1)."""
    x, y = geo.polar_to_xy(F.col("distance"), F.col("bearing"))
    h = F.coalesce(F.col("height"), F.lit(0.0))
    rows = field.select(
        "plot_id", F.col("tree_id").alias("_src"), x.alias("x_tree_bh"), y.alias("y_tree_bh"), F.lit(dbh_height).alias("z_tree_bh"),
        "distance", "bearing", forest.cm_to_mm(F.col("dbh_cm")).alias("dbh"), F.lit(100.0).alias("cci_at_bh"),
        F.when(h == 0, h + F.coalesce(F.col("prev_height"), F.lit(0.0))).otherwise(h).alias("height"),
        F.when(h == 0, 1).otherwise(0).alias("review"),
    )
    return ranked_by_bearing(rows, "tree_id", "_src").select(*FIELD_COLUMNS)


def vr_reshape(vr: DataFrame) -> DataFrame:
    """Three export lines per tree to one row: the second holds the diameter record,
    the third the height. Needs an explicit line number."""
    tree = F.floor(F.col("line_no") / 3).alias("_tree")
    kind = F.pmod(F.col("line_no"), F.lit(3))
    first = [F.max(F.when(kind == 1, F.col(c))).alias(n) for c, n in (
        ("x", "x_tree_bh"), ("y", "y_tree_bh"), ("position", "z_tree_bh"), ("distance", "distance"), ("bearing", "bearing"), ("diameter", "dbh"))]
    height = F.max(F.when(kind == 2, F.col("position"))).alias("height")
    return vr.groupBy("plot_id", tree).agg(*first, height).filter(F.col("dbh").isNotNull())


def vr_to_trees(vr: DataFrame) -> DataFrame:
    rows = vr_reshape(vr).withColumns({"cci_at_bh": F.lit(100.0), "review": F.lit(1)})
    return ranked_by_bearing(rows, "tree_id", "_tree").select(*FIELD_COLUMNS)


def add_dub_column(diameters: DataFrame, dbh_height: float = 1.4) -> DataFrame:
    """Under-bark diameter with the tree's first height; incomplete rows are dropped."""
    rows = diameters.dropna(subset=["ma_diameter", "tree_height"])
    first = rows.groupBy("tree_id").agg(F.min_by("tree_height", "row_id").alias("_h"))
    out = rows.join(first, "tree_id")
    return out.select(*diameters.columns, forest.under_bark(F.col("ma_diameter"), F.col("_h"), dbh_height).alias("dub"))


def missing_dbh_fill(trees: DataFrame, margin: float = 0.1) -> DataFrame:
    """Fill missing diameters from trees of similar height.

    The height band starts at ``margin`` and grows by it until it holds a measured
    tree: the step follows from the distance to the nearest measured height, found with
    one window over distinct heights per plot. Trees without a height stay open.
    """
    missing = F.col("dbh_mm").isNull() | F.col("cci").isNull()
    real = trees.filter(~missing & F.col("height").isNotNull())
    real = real.groupBy("plot_id", "height", "dbh_mm").agg(F.count(F.lit(1)).alias("_n"))
    want = trees.filter(missing & F.col("height").isNotNull()).select("plot_id", "height").distinct()

    marks = real.select("plot_id", "height", F.col("height").alias("_real")).distinct().unionByName(
        want.select("plot_id", "height", F.lit(None).cast("double").alias("_real"))
    )
    up = Window.partitionBy("plot_id").orderBy("height").rangeBetween(Window.unboundedPreceding, 0)
    down = Window.partitionBy("plot_id").orderBy("height").rangeBetween(0, Window.unboundedFollowing)
    gaps = marks.select(
        "plot_id", "height", "_real",
        (F.col("height") - F.max("_real").over(up)).alias("_a"), (F.min("_real").over(down) - F.col("height")).alias("_b"),
    ).filter("_real IS NULL")
    gap = F.least("_a", "_b")
    bands = gaps.filter(gap.isNotNull()).select("plot_id", "height", ((F.floor(gap / margin) + 1) * margin).alias("_m"))
    cells = F.sequence(F.floor((F.col("height") - F.col("_m")) / margin), F.floor((F.col("height") + F.col("_m")) / margin))
    bands = bands.withColumn("_c", F.explode(cells)).withColumnRenamed("height", "_h")
    near = real.withColumn("_c", F.floor(F.col("height") / margin)).join(bands, ["plot_id", "_c"])
    near = near.filter(F.abs(F.col("height") - F.col("_h")) < F.col("_m"))
    fill = near.groupBy("plot_id", F.col("_h").alias("height")).agg(F.floor(F.percentile("dbh_mm", F.lit(0.5), F.col("_n"))).cast("double").alias("_fill"))
    out = trees.join(fill, ["plot_id", "height"], "left")
    return out.select(
        *[c for c in trees.columns if c not in ("dbh_mm", "cci")],
        F.when(missing, F.col("_fill")).otherwise(F.col("dbh_mm")).alias("dbh_mm"),
        F.when(missing, F.lit(0.5)).otherwise(F.col("cci")).alias("cci"),
        missing.cast("int").alias("review"),
    )


def detected_tree_positions(cylinders: DataFrame, max_height: float = 3.01, min_cci: float = 0.1, min_angle: float = 80.0) -> DataFrame:
    """Mean xy of the low, upright cylinders of trees that have more than two of them."""
    angle = geo.lean_to_horizontal([F.col(c) for c in ("nx", "ny", "nz")])
    low = cylinders.filter((F.col("height_above_dtm") < max_height) & (F.col("cci") > min_cci) & (angle > min_angle))
    pos = low.groupBy("plot_id", "tree_id").agg(F.avg("x").alias("x"), F.avg("y").alias("y"), F.count(F.lit(1)).alias("_n"))
    return pos.filter("_n > 2").drop("_n")


def match_qc_trees(qc: DataFrame, detected: DataFrame, max_range: float = 0.2) -> tuple[DataFrame, DataFrame]:
    """One-to-one matching in QC-id order: each QC tree takes its nearest detected tree
    that is still free. Returns (matches, unmatched QC trees).

    Per round an edge is accepted when no other open QC tree with a smaller id can
    reach the same target, or when that QC tree is the smallest in reach of all its
    targets; the loop runs on candidate edges only, never on the trees.
    """
    d = detected.select("plot_id", F.col("tree_id").alias("target"), *XY)
    pairs = radius_pairs(qc.select("plot_id", "qc_id", *XY), d, max_range, XY, inclusive=False)
    edges = cut_lineage(pairs.select("plot_id", "qc_id", F.col("near.target").alias("target"), "dist"))
    found: list[DataFrame] = []
    per_qc = Window.partitionBy("plot_id", "qc_id").orderBy("dist", "target")
    while not edges.isEmpty():
        first_claim = edges.groupBy("plot_id", "target").agg(F.min("qc_id").alias("_first"))
        ranked = edges.join(first_claim, ["plot_id", "target"]).withColumn("_r", F.row_number().over(per_qc))
        # the nearest target is final once no smaller open QC id can reach it
        take = cut_lineage(ranked.filter((F.col("_r") == 1) & (F.col("qc_id") == F.col("_first"))).select("plot_id", "qc_id", "target", "dist"))
        found.append(take)
        edges = edges.join(take.select("plot_id", "qc_id"), ["plot_id", "qc_id"], "left_anti")
        edges = cut_lineage(edges.join(take.select("plot_id", "target"), ["plot_id", "target"], "left_anti"))
    schema = edges.select("plot_id", "qc_id", "target", "dist")
    matches = reduce(DataFrame.unionByName, found, schema)
    return matches, qc.join(matches.select("plot_id", "qc_id"), ["plot_id", "qc_id"], "left_anti")
