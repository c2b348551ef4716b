"""Tree measurement: taper, diameter, volume, height, point assignment."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arborframe.functions import forestry as forest
from arborframe.functions import geometry as geo
from arborframe.functions.numeric import half_even
from arborframe.operators.nearest import nearest_rows, nearest_within, one_array
from arborframe.operators.spatial import XY, XYZ, radius_pairs

TREE = ("plot_id", "tree_id")


# ---------------------------------------------------------------- taper tables
def taper_summary(taper: DataFrame) -> DataFrame:
    """Top taper row of every tree."""
    w = Window.partitionBy(*TREE).orderBy(F.desc("height_bin"))
    return taper.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")


def dbh_rows(taper: DataFrame, dbh_height: float, minimum_dbh: float = 0.0) -> DataFrame:
    """Taper row at breast height, else the nearest bin (lower bin on ties)."""
    gap = F.abs(F.col("height_bin") - dbh_height)
    w = Window.partitionBy(*TREE).orderBy(gap, "height_bin")
    return (
        taper.withColumn("_r", F.row_number().over(w))
        .filter("_r = 1")
        .drop("_r")
        .filter(F.col("ma_diameter") >= minimum_dbh)
    )


def crown_height(taper: DataFrame, mode: str = "height") -> DataFrame:
    """Highest pruned bin of a tree; ``mode='reference'`` gives that row's diameter."""
    value = F.col("height_bin") if mode == "height" else F.col("ma_diameter")
    pruned = F.col("s_count") > F.col("ns_count") / 10.0
    return taper.groupBy(*TREE).agg(
        F.coalesce(F.max_by(F.when(pruned, value), F.when(pruned, F.col("height_bin"))), F.lit(0.0)).alias("crown_height")
    )


def _with_next(taper: DataFrame, diameters: Sequence[str]) -> DataFrame:
    w = Window.partitionBy(*TREE).orderBy("height_bin")
    return taper.select(
        "*", F.lead("height_bin").over(w).alias("_h2"), *[F.lead(d).over(w).alias(f"_next_{d}") for d in diameters]
    )


def _gap(dbh_height: float) -> Column:
    """Distance of a bin to breast height; the lower bin wins ties."""
    return F.abs(F.col("height_bin") - dbh_height) + F.col("height_bin") * 1e-9


def _body(d: str) -> Column:
    length = F.col("_h2") - F.col("height_bin")
    return F.coalesce(F.sum(forest.frustum(F.col(d), F.col(f"_next_{d}"), length)), F.lit(0.0))


def _stem_volume(body: Column, d_lo: Column, d_hi: Column) -> Column:
    """Frusta plus the cone up to the tree top plus the cylinder down to 0.3 m."""
    top = (F.col("height") - F.col("_hi")) * F.pi() * d_hi * d_hi / 12.0
    return body + top + F.pi() * d_lo * d_lo / 4.0 * (F.col("_lo") - 0.3)


def volumes(taper: DataFrame, dbh_height: float, diameter: str = "ma_diameter") -> DataFrame:
    """Frustum volume, cone volume and the bin used for DBH, one row per tree.

    One shuffle: neighbours by ``lead``, end terms by min_by / max_by on the same key.
    """
    gap = _gap(dbh_height)
    per_tree = _with_next(taper, [diameter]).groupBy(*TREE).agg(
        F.first("height").alias("height"),
        _body(diameter).alias("_body"),
        F.min("height_bin").alias("_lo"),
        F.max("height_bin").alias("_hi"),
        F.min_by(diameter, "height_bin").alias("_d_lo"),
        F.max_by(diameter, "height_bin").alias("_d_hi"),
        F.min_by("height_bin", gap).alias("dbh_bin"),
        F.min_by(diameter, gap).alias("dbh"),
    )
    return per_tree.select(
        *TREE,
        _stem_volume(F.col("_body"), F.col("_d_lo"), F.col("_d_hi")).alias("volume_1"),
        forest.cone_over_cylinder(F.col("dbh"), F.col("height"), F.col("dbh_bin")).alias("volume_2"),
        "dbh_bin", "dbh", "height",
    )


def under_bark_taper(taper: DataFrame, dbh_height: float) -> DataFrame:
    return taper.withColumn("dub", forest.under_bark(F.col("ma_diameter"), F.col("height"), dbh_height))


def tree_table(taper: DataFrame, plots: DataFrame, dbh_height: float = 1.3, minimum_dbh: float = 0.0) -> DataFrame:
    """Tree rows of the deliverable: diameter, volume, under-bark values, position, bearing.

    The taper is shuffled once by tree; every measure comes from one window and one
    aggregate over that layout.
    """
    gap = _gap(dbh_height)
    d = "ma_diameter"
    per_tree = _with_next(under_bark_taper(taper, dbh_height), [d, "dub"]).groupBy(*TREE).agg(
        F.first("height").alias("height"),
        _body(d).alias("_body"),
        _body("dub").alias("_body_ub"),
        F.min("height_bin").alias("_lo"),
        F.max("height_bin").alias("_hi"),
        *[F.min_by(c, "height_bin").alias(f"_lo_{c}") for c in (d, "dub")],
        *[F.max_by(c, "height_bin").alias(f"_hi_{c}") for c in (d, "dub")],
        *[F.min_by(c, gap).alias(n) for c, n in ((d, "dbh_m"), ("height_bin", "dbh_bin"), ("bin_x", "bin_x"), ("bin_y", "bin_y"), ("cci", "cci"))],
    )
    out = per_tree.filter(F.col("dbh_m") >= minimum_dbh).join(plots.select("plot_id", "cx", "cy"), "plot_id")
    here = [F.col(c) for c in ("bin_x", "bin_y", "cx", "cy")]
    return out.select(
        *TREE,
        half_even(F.col("bin_x"), 3).alias("tree_x"),
        half_even(F.col("bin_y"), 3).alias("tree_y"),
        geo.distance_xy(*here).alias("distance"),
        geo.bearing(*here).alias("bearing"),
        half_even(F.col("height"), 2).alias("height"),
        forest.metres_to_mm(F.col("dbh_m")).alias("dbh_taper"),
        half_even(F.col("dbh_bin"), 1).alias("dbh_bin"),
        F.rint("cci").alias("cci"),
        half_even(_stem_volume(F.col("_body"), F.col(f"_lo_{d}"), F.col(f"_hi_{d}")), 3).alias("volume"),
        half_even(forest.cone_over_cylinder(F.col("dbh_m"), F.col("height"), F.col("dbh_bin")), 3).alias("volume_2"),
        F.rint(forest.under_bark(F.col("dbh_m"), F.col("height"), dbh_height) * 1000.0).alias("dub"),
        half_even(_stem_volume(F.col("_body_ub"), F.col("_lo_dub"), F.col("_hi_dub")), 3).alias("vub"),
    )


# ---------------------------------------------------------------- numbering
def ranked_by_bearing(df: DataFrame, name: str, tree_id: str = "tree_id", by: str = "plot_id") -> DataFrame:
    """1..n per plot in (bearing, id) order.

    Ranks are taken inside (plot, bearing) and shifted by the counts of the smaller
    bearings (at most 360 rows per plot), so one plot never sits in a single sort.
    """
    counts = df.groupBy(by, "bearing").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(by).orderBy("bearing").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(by, "bearing", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy(by, "bearing").orderBy(tree_id)
    ranked = df.withColumn("_rank", F.row_number().over(inside)).join(offsets, [by, "bearing"])
    return ranked.select(*df.columns, (F.col("_offset") + F.col("_rank")).cast("long").alias(name))


def number_by_bearing(trees: DataFrame, accepted: Column) -> DataFrame:
    """Accepted trees numbered 1..n by bearing, rejected trees coded -1."""
    good = ranked_by_bearing(trees.filter(accepted), "tree_number")
    return good.unionByName(trees.filter(~accepted).withColumn("tree_number", F.lit(-1).cast("long")))


# ---------------------------------------------------------------- points to trees
def voting(classes: Sequence[str], k: int) -> Callable:
    """Labels of rows 0 to n - 1 from their nearest votes and the distances; None for votes that NumPy orders in another way than Spark."""

    def run(row: np.ndarray, near: pa.Table, dist: np.ndarray, n: int) -> np.ndarray | None:
        columns = [one_array(near[c]) for c in ("near_id", *[f"_t_{c}" for c in classes])]
        if not classes or any(c.null_count or not (pa.types.is_floating(c.type) or pa.types.is_integer(c.type)) for c in columns):
            return None
        ids, *values = (c.to_numpy(zero_copy_only=False) for c in columns)
        order = np.lexsort((*reversed(values), ids, dist, row))
        row = row[order]
        size = np.bincount(row, minlength=n)
        place = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
        nearest = place < k
        row, place, order, size = row[nearest], place[nearest], order[nearest], np.minimum(size, k)
        middle = []
        for v in values:
            wide = np.full((n, k), np.nan)
            wide[row, place] = v[order]
            wide.sort(axis=1)  # what is not a number is last, as what is not there
            middle.append((wide[np.arange(n), (size + 1) // 2 - 1] + wide[np.arange(n), size // 2]) / 2.0)
        return np.argmax(np.column_stack(middle), axis=1)

    return run


def label_vote(points: DataFrame, votes: DataFrame, k: int = 5) -> DataFrame:
    """Label = first largest of the class-wise median probabilities of the k nearest votes.

    A point whose votes are all in the chunk it is searched in leaves the search with its label; only the others' votes are rows.
    """
    classes = [c for c in votes.columns if c.startswith("p") and c[1:].isdigit()]
    near, done = nearest_rows(points, votes, k, "point_id", "vote_id", take=classes, finish=voting(classes, k))
    # k conditional maxima per class keep the aggregate on primitive buffers
    slots = [F.max(F.when(F.col("rank") == r, F.col(c))).alias(f"_{c}_{r}") for c in classes for r in range(1, k + 1)]
    wide = near.groupBy("plot_id", "point_id").agg(*slots)

    def median(c: str) -> Column:
        values = F.array_sort(F.array_compact(F.array(*[F.col(f"_{c}_{r}") for r in range(1, k + 1)])))
        n = F.size(values)
        lo, hi = F.floor((n + 1) / 2).cast("int"), F.floor(n / 2 + 1).cast("int")
        return (F.element_at(values, lo) + F.element_at(values, hi)) / 2.0

    p = F.array(*[median(c) for c in classes])
    label = wide.select("plot_id", "point_id", (F.array_position(p, F.array_max(p)) - 1).cast("int").alias("label"))
    return label.unionByName(done.select("plot_id", "point_id", F.col("_done").cast("int").alias("label")))


def votes_to_class(votes: DataFrame, logits: Sequence[str]) -> DataFrame:
    """Softmax of the class scores and the first best class."""
    peak = F.greatest(*[F.col(c) for c in logits])
    e = [F.exp(F.col(c) - peak) for c in logits]
    total = sum(e[1:], e[0])
    p = F.array(*[x / total for x in e])
    return votes.withColumn("p", p).withColumn("class", (F.array_position(p, F.array_max(p)) - 1).cast("int"))


def assign_points(points: DataFrame, cylinders: DataFrame, max_range: float, coords: Sequence[str] = XYZ) -> tuple[DataFrame, DataFrame]:
    """Points take the tree of the nearest cylinder within range; (assigned, rest)."""
    slim = cylinders.select("plot_id", "cyl_id", *coords, "tree_id")
    bare = points.drop("tree_id")
    out = nearest_within(bare, slim, max_range, "point_id", "cyl_id", coords, take=("tree_id",)).drop("near_id", "near_dist")
    return out.filter(F.col("tree_id").isNotNull()), out.filter(F.col("tree_id").isNull()).drop("tree_id")


def order_statistic(rows: DataFrame, value: str, share: float, name: str) -> DataFrame:
    """Value at sorted position int(n * share) per plot, from counts of equal values."""
    counts = rows.groupBy("plot_id", value).agg(F.count(F.lit(1)).alias("_n"))
    up_to = Window.partitionBy("plot_id").orderBy(value)
    total = Window.partitionBy("plot_id")
    cum = counts.withColumn("_c", F.sum("_n").over(up_to)).withColumn("_t", F.sum("_n").over(total))
    return cum.filter(F.col("_c") > F.floor(F.col("_t") * share)).groupBy("plot_id").agg(F.min(value).alias(name))


def assign_stem_2d(rest: DataFrame, cylinders: DataFrame, max_range: float) -> tuple[DataFrame, DataFrame]:
    """Left-over stem points: nearest in xy among cylinders above the middle height."""
    mid = order_statistic(cylinders, "z", 0.5, "_t")
    upper = cylinders.join(mid, "plot_id").filter(F.col("z") > F.col("_t"))
    return assign_points(rest, upper, max_range, XY)


def assign_veg_levels(
    rest: DataFrame, cylinders: DataFrame, max_range: float, levels: Sequence[float] = (0.9, 0.8, 0.7), min_left: int = 0
) -> tuple[DataFrame, DataFrame]:
    """Left-over vegetation in passes over falling cylinder bands, range shrinking by
    0.5 m per pass; the last pass uses every cylinder below the plot's last band. By
    default every plot runs all passes; with ``min_left`` (10000 in the original rule) a
    plot leaves them once fewer points are open."""
    from arborframe.lineage import cut_lineage

    inf = float("inf")
    state = cylinders.select("plot_id").distinct().withColumns({"_t1": F.lit(inf), "_on": F.lit(True)})
    done: list[DataFrame] = []
    for i, level in enumerate(levels):
        t2 = order_statistic(cylinders, "z", level, "_t2")
        state = state.join(t2, "plot_id")
        lo = F.when(F.col("_on"), F.col("_t2")).otherwise(F.lit(inf))
        band = cylinders.join(state, "plot_id").filter((F.col("z") <= F.col("_t1")) & (F.col("z") > lo))
        got, rest = assign_points(rest, band, max_range - 0.5 * i, XY)
        done.append(cut_lineage(got))
        rest = cut_lineage(rest)
        left = rest.groupBy("plot_id").agg(F.count(F.lit(1)).alias("_left"))
        state = state.join(left, "plot_id", "left").select(
            "plot_id",
            F.when(F.col("_on"), F.col("_t2")).otherwise(F.col("_t1")).alias("_t1"),
            (F.col("_on") & (F.coalesce("_left", F.lit(0)) >= min_left)).alias("_on"),
        )
        state = cut_lineage(state)
    lower = cylinders.join(state, "plot_id").filter(F.col("z") < F.col("_t1"))
    got, rest = assign_points(rest, lower, max_range, XY)
    out = got
    for d in done:
        out = out.unionByName(d)
    return out, rest


# ---------------------------------------------------------------- per-tree measures
def tree_height(points: DataFrame) -> DataFrame:
    """Height (max above ground, 2 decimals) and top point per tree.

    Two hash aggregates: maxima first, then the lowest id among the points at the top.
    """
    top = points.groupBy(*TREE).agg(F.max("hag").alias("_h"), F.max("z").alias("_z"))
    at_top = points.select(*TREE, "point_id", *XYZ).join(top, list(TREE)).filter(F.col("z") == F.col("_z"))
    first = at_top.groupBy(*TREE).agg(
        F.first("_h").alias("_h"), *[F.min_by(c, "point_id").alias(f"crown_top_{c}") for c in XYZ]
    )
    return first.select(
        *TREE, half_even(F.col("_h"), 2).alias("height"), *[half_even(F.col(f"crown_top_{c}"), 3).alias(f"crown_top_{c}") for c in XYZ]
    )


def crown_mean(points: DataFrame, vegetation: int = 2) -> DataFrame:
    veg = F.col("label") == vegetation
    return points.groupBy(*TREE).agg(
        *[half_even(F.avg(F.when(veg, F.col(c))), 3).alias(f"crown_mean_{c}") for c in XY]
    )


def tree_base(stem_points: DataFrame, cylinders: DataFrame, min_cluster: int = 40) -> DataFrame:
    """Base position: xy of the lowest cylinder, z of the ground under the highest of
    the stem points nearest the ground."""
    low = stem_points.groupBy(*TREE).agg(F.min("hag").alias("_low"))
    gap = F.col("hag") - F.col("_low")
    near = stem_points.select(*TREE, "point_id", "z", "hag").join(low, list(TREE)).filter(gap < 0.04).withColumn("_gap", gap)
    tight = F.col("_gap") < 0.01
    top = F.struct("z", (-F.col("point_id")).alias("_id"))
    ground = F.col("z") - F.col("hag")
    picked = near.groupBy(*TREE).agg(
        F.count(F.when(tight, 1)).alias("_n"),
        F.max_by(ground, F.when(tight, top)).alias("_g1"),
        F.max_by(ground, top).alias("_g4"),
    )
    base_z = picked.select(*TREE, F.when(F.col("_n") < min_cluster, F.col("_g4")).otherwise(F.col("_g1")).alias("base_z"))
    order = F.struct("height_above_dtm", "cyl_id")
    base_xy = cylinders.groupBy(*TREE).agg(*[F.min_by(c, order).alias(f"base_{c}") for c in XY])
    return base_xy.join(base_z, list(TREE))


def _binned(rows: DataFrame, base: DataFrame, margin: float, start: float, step: float) -> DataFrame:
    """Rows copied to every height bin whose centre is within ``margin`` of their height
    over the tree base; the bin range is arithmetic on the row, not a range join."""
    rel = F.col("z") - F.col("base_z")
    lo = F.greatest(F.floor((rel - margin - start) / step), F.lit(0).cast("long"))
    hi = F.least(F.floor((rel + margin - start) / step) + 1, F.col("n_bins") - 1)
    out = rows.join(base, list(TREE)).filter(lo <= hi).withColumn("_k", F.explode(F.sequence(lo, hi)))
    out = out.withColumn("height_bin", (start * 10 + F.col("_k") * (step * 10)) / 10.0)
    z0 = F.col("base_z") + F.col("height_bin")
    return out.filter((F.col("z") >= z0 - margin) & (F.col("z") <= z0 + margin))


def taper(
    cylinders: DataFrame,
    points: DataFrame,
    base: DataFrame,
    start: float = 0.5,
    stop: float = 50.0,
    step: float = 0.1,
    margin: float = 0.3,
    dbh_correction_mm: float = 0.0,
    point_margin: float = 0.15,
    stem: int = 4,
    vegetation: int = 2,
) -> DataFrame:
    """Taper rows per tree and height bin: moving-average diameter, centre, point counts."""
    tallest = cylinders.groupBy("plot_id").agg(F.max("height_above_dtm").alias("_top"))
    n_bins = F.ceil((F.least(F.col("_top"), F.lit(stop)) * 10 - start * 10) / (step * 10)).cast("long")
    base = base.select(*TREE, "base_z").join(tallest, "plot_id").select(*TREE, "base_z", n_bins.alias("n_bins"))
    key = [*TREE, "height_bin"]
    stems = cylinders.filter((F.col("main_stem") > 0) & (F.col("radius") > 0)).select(*TREE, *XYZ, "radius", "cci")
    disc = _binned(stems, base, margin, start, step).groupBy(*key).agg(
        half_even(half_even(F.avg("radius") * 2, 9), 3).alias("_d"),
        half_even(half_even(F.avg("cci"), 9)).alias("cci"),
        half_even(half_even(F.avg("x"), 9), 3).alias("bin_x"),
        half_even(half_even(F.avg("y"), 9), 3).alias("bin_y"),
    )
    cloud = points.filter(F.col("label").isin(stem, vegetation)).select(*TREE, "z", "label")
    counts = _binned(cloud, base, point_margin, start, step).groupBy(*key).agg(
        F.count(F.when(F.col("label") == stem, 1)).alias("s_count"),
        F.count(F.when(F.col("label") == vegetation, 1)).alias("ns_count"),
    )
    zero = F.lit(0).cast("long")
    s, ns = F.coalesce("s_count", zero), F.coalesce("ns_count", zero)
    corrected = F.col("_d") + F.when(F.col("height_bin") <= 2, dbh_correction_mm / 1000.0).otherwise(0.0)
    return disc.join(counts, key, "left").select(
        *key, corrected.alias("ma_diameter"), "bin_x", "bin_y", s.alias("s_count"), ns.alias("ns_count"),
        (s > ns / 10.0).cast("int").alias("pruned"), "cci",
    )


def dbh_fit_points(stem_points: DataFrame, taper_rows: DataFrame, dbh_height: float, min_cluster: int = 40) -> DataFrame:
    """Stem points of the diameter picture: a thin band at breast height, or at the
    better of the two lowest bins when no bin is near breast height."""
    w = Window.partitionBy(*TREE).orderBy("height_bin")
    rows = taper_rows.withColumn("_r", F.row_number().over(w))
    best = rows.groupBy(*TREE).agg(
        F.max((F.abs(F.col("height_bin") - dbh_height) < 0.15).cast("int")).alias("_near"),
        F.max_by(
            F.when(F.col("_r") <= 2, F.col("height_bin")),
            F.when(F.col("_r") <= 2, F.struct(F.col("cci"), (-F.col("_r")).alias("_o"))),
        ).alias("_alt"),
    )
    best = best.select(*TREE, F.when(F.col("_near") == 1, F.lit(float(dbh_height))).otherwise(F.col("_alt")).alias("_best"))
    near = stem_points.join(best, list(TREE)).withColumn("_gap", F.abs(F.col("hag") - F.col("_best"))).filter("_gap < 0.1")
    n = near.groupBy(*TREE).agg(F.count(F.when(F.col("_gap") < 0.05, 1)).alias("_n"))
    keep = F.when(F.col("_n") < min_cluster, F.col("_gap") < 0.1).otherwise(F.col("_gap") < 0.05)
    return near.join(n, list(TREE)).filter(keep).select(*stem_points.columns)


def with_tree_ground(ground_points: DataFrame, skeleton: DataFrame, max_range: float) -> DataFrame:
    """Ground points near each tree in plan view, one row per (tree, point)."""
    pairs = radius_pairs(ground_points, skeleton.select(*TREE, *XY).distinct(), max_range, XY)
    return pairs.select("plot_id", F.col("near.tree_id").alias("tree_id"), "point_id").distinct()
