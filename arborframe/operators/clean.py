"""Cleaning, cropping, relabelling and thinning of point tables."""

from __future__ import annotations

import itertools
from collections.abc import Callable
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arborframe.functions.numeric import half_even, id_normal
from arborframe.lineage import cut_lineage, release
from arborframe.operators.celltree import search, within
from arborframe.operators.nearest import nearest_rows, numbers, one_array, spans, with_neighbourhood
from arborframe.operators.spatial import XYZ, radius_pairs

NOISE, TERRAIN, VEGETATION, CWD, STEM, UNUSED = 0, 1, 2, 3, 4, 6
NOISE_CLASSIFICATION = 7
#: Points in the cell of a point, on average, up to which all pairs within a radius are made; denser clouds are searched by chunks.
PAIR_MATES = 4
#: Points up to which pairs may be made at all.
PAIR_ROWS = 200_000
#: Points of a chunk.
THIN_ROWS = 32_768
#: A chunk of more points (copies of a position, which no cell parts) is not searched as one group.
CROWDED = 1_000_000


# ---------------------------------------------------------------- plots and crops
def plot_extent(points: DataFrame) -> DataFrame:
    """Bounding box per plot. Partial aggregates run before the shuffle."""
    return points.groupBy("plot_id").agg(
        *[f(c).alias(f"{n}_{c}") for c in XYZ for f, n in ((F.min, "min"), (F.max, "max"))]
    )


def plot_centre(points: DataFrame) -> DataFrame:
    box = plot_extent(points)
    return box.select(
        "plot_id",
        half_even((F.col("min_x") + F.col("max_x")) / 2.0, 3).alias("cx"),
        half_even((F.col("min_y") + F.col("max_y")) / 2.0, 3).alias("cy"),
        half_even(F.col("min_z"), 3).alias("z0"),
    )


def _from_centre(x: str = "x", y: str = "y") -> Column:
    dx, dy = F.col(x) - F.col("cx"), F.col(y) - F.col("cy")
    return F.sqrt(dx * dx + dy * dy)


def crop_circle(points: DataFrame, plots: DataFrame, with_buffer: bool = True, inclusive: bool = False) -> DataFrame:
    """Keep points inside the plot circle; a radius of 0 keeps everything."""
    centre = plots.select("plot_id", "cx", "cy", "plot_radius", F.col("plot_radius_buffer").alias("_b"))
    limit = F.col("plot_radius") + (F.col("_b") if with_buffer else F.lit(0.0))
    inside = _from_centre() <= limit if inclusive else _from_centre() < limit
    joined = points.join(cut_lineage(centre), "plot_id")
    return joined.filter((F.col("plot_radius") == 0) | inside).select(*points.columns)


def shift_origin(points: DataFrame, plots: DataFrame) -> DataFrame:
    joined = points.join(plots.select("plot_id", "cx", "cy"), "plot_id")
    moved = {"x": F.col("x") - F.col("cx"), "y": F.col("y") - F.col("cy")}
    return joined.withColumns(moved).select(*points.columns)


# ---------------------------------------------------------------- noise
def drop_noise_class(points: DataFrame) -> DataFrame:
    if "classification" not in points.columns:
        return points
    return points.filter(F.col("classification") != NOISE_CLASSIFICATION)


def filter_returns(points: DataFrame, top_band: float = 5.0) -> DataFrame:
    """Mobile scans (numbers from 0) keep first returns; airborne scans drop returns
    below 2 except in the top ``top_band`` metres. Decided per plot."""
    if "return_number" not in points.columns:
        return points
    per_plot = points.groupBy("plot_id").agg(
        F.min("return_number").alias("_lo"), F.max("return_number").alias("_hi"), F.max("z").alias("_top")
    )
    rn = F.col("return_number")
    keep = (
        F.when(F.col("_lo") == 0, rn <= 0)
        .when(F.col("_hi") > 1, ~((rn < 2) & (F.col("z") < F.col("_top") - top_band)))
        .otherwise(F.lit(True))
    )
    return points.join(cut_lineage(per_plot), "plot_id").filter(keep).select(*points.columns)


def split_low_intensity(points: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """(kept points, low-intensity points)."""
    return points.filter(F.col("intensity") >= threshold), points.filter(F.col("intensity") < threshold)


def low_intensity_vegetation(low: DataFrame, stem_min_height: float, base_cutoff: float) -> DataFrame:
    """Low-intensity points that come back as vegetation, filtered on height above ground."""
    return low.filter(F.col("hag") > max(stem_min_height, base_cutoff)).withColumn("label", F.lit(VEGETATION))


def filter_far_range(points: DataFrame, range_col: str = "scan_range", max_range: float = 20.0, band: float = 5.0) -> DataFrame:
    low = points.groupBy("plot_id").agg(F.min("z").alias("_low"))
    far = (F.col(range_col) > max_range) & (F.col("z") < F.col("_low") + band)
    return points.join(cut_lineage(low), "plot_id").filter(~far).select(*points.columns)


def dedup_xyz(points: DataFrame, decimals: int = 3) -> DataFrame:
    """Lowest id per rounded position. The rank limit also runs before the shuffle, so
    a large group of copies shrinks to one row per map task."""
    spot = [half_even(F.col(c), decimals) for c in XYZ]
    w = Window.partitionBy("plot_id", *spot).orderBy("point_id")
    return points.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")


def closest_within(points: DataFrame, spacing: float, by: tuple[str, ...], spacing_col: str | None = None) -> DataFrame:
    """(by, point_id, near): distance, id and z of the closest other point that is nearer than the spacing."""
    key = [*by, "point_id"]
    cells = points.groupBy(*by, *[F.floor(F.col(c) / spacing) for c in XYZ]).agg(F.count(F.lit(1)).alias("_n"))
    mates = cells.agg(F.sum(F.col("_n") * F.col("_n")) / F.sum("_n")).first()[0]
    if not mates or mates <= PAIR_MATES:
        pairs = radius_pairs(points, points, spacing, by=by, inclusive=False, size=2 * spacing).filter(F.col("point_id") != F.col("near.point_id"))
        if spacing_col:
            pairs = pairs.filter(F.col("dist") < F.col(spacing_col))
        return pairs.groupBy(*key).agg(F.min(F.struct(F.col("dist"), F.col("near.point_id").alias("id"), F.col("near.z").alias("z"))).alias("near"))
    near = nearest_rows(points, points, 1, "point_id", "point_id", by=by, within=spacing, exclude_self=True, take=("z",)).filter(F.col("near_dist") < spacing)
    near = near.select(*key, F.struct(F.col("near_dist").alias("dist"), F.col("near_id").alias("id"), "z").alias("near"))
    if not spacing_col:
        return near
    # points of a group have its spacing
    own = points.groupBy(*key).agg(F.max(spacing_col).alias("_own"))
    return near.join(own, key).filter(F.col("near.dist") < F.col("_own")).drop("_own")


def thinning(kept: list[str], limit_of: Callable, schema: T.StructType) -> Callable:
    """The own points of a chunk that stay (``_wait`` false) or try again (true); points that go are left out."""

    def run(rows: pa.Table) -> pa.Table:
        at, own = numbers(rows, XYZ).astype(float), one_array(rows["_own"]).to_numpy(zero_copy_only=False).astype(bool)
        ids, limit = one_array(rows["point_id"]).to_numpy(zero_copy_only=False), limit_of(rows)
        close, lower = np.zeros(len(at), bool), np.zeros(len(at), bool)
        for all_of in spans(one_array(rows["_group"]).to_numpy(zero_copy_only=False)):
            mine = all_of[own[all_of]]
            if len(mine):
                pairs = within(at[all_of], np.flatnonzero(own[all_of]), limit[all_of], limit[mine].max())
                if pairs is None:
                    a, b, dist, _ = search(at[mine], at[all_of], 1, limit[mine], (mine, all_of))
                    a, b = mine[a], all_of[b]
                    near = dist < limit[a]
                    a, b, dist = a[near], b[near], dist[near]
                else:
                    a, b, dist = all_of[pairs[0]], all_of[pairs[1]], pairs[2]
                order = np.lexsort((ids[b], dist, a))
                a, first = np.unique(a[order], return_index=True)
                b = b[order][first]
                close[a], lower[a] = True, at[a, 2] < at[b, 2]
        used = pa.array(np.flatnonzero(own & (~close | lower)))
        out = {c: one_array(rows[c]).take(used) for c in kept}
        out["_wait"] = pa.array(lower[used.to_numpy()])
        return pa.table([out[f.name] for f in schema.fields], names=[f.name for f in schema.fields])

    return run


def thinned_once(points: DataFrame, spacing: float, by: tuple[str, ...], spacing_col: str | None) -> DataFrame | None:
    """One round of thinning in chunks for points of different ids, written: those that stay and, with ``_wait``, those that try again. No pair
    is written or shuffled. None when a chunk is too crowded."""
    whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in (*by, "point_id")] + [F.abs(F.col(c).cast("double")) < float("inf") for c in XYZ])
    known = F.coalesce(whole, F.lit(False))
    dealt = with_neighbourhood(points.filter(known), spacing, by=by, most=THIN_ROWS)
    alone = points.filter(~known).withColumn("_wait", F.lit(False))
    if dealt is None:
        return cut_lineage(alone)
    rows, largest = dealt
    if largest > CROWDED:
        return None

    def limit_of(rows: pa.Table) -> np.ndarray:
        if not spacing_col:
            return np.full(rows.num_rows, float(spacing))
        # without a spacing of its own a point is near none
        own = one_array(rows[spacing_col]).cast(pa.float64()).fill_null(0.0).to_numpy(zero_copy_only=False)
        return np.fmin(own, float(spacing))

    schema = T.StructType([*points.schema.fields, T.StructField("_wait", T.BooleanType())])
    return cut_lineage(rows.groupBy("_chunk").applyInArrow(thinning(points.columns, limit_of, schema), schema).unionByName(alone))


def thin_min_spacing(
    points: DataFrame,
    spacing: float,
    by: tuple[str, ...] = ("plot_id",),
    spacing_col: str | None = None,
    written: bool = False,
    unique: bool | None = None,
) -> DataFrame:
    """Keep points whose nearest neighbour is at least ``spacing`` away; of the close
    ones, those lower than their neighbour try again among themselves.

    Works on a shrinking remainder of ids and positions; a remainder of one point per
    group is dropped, as the rule compares at least two points. ``spacing_col`` gives
    each group its own spacing, at most ``spacing``. ``written`` says that points are cheap
    to read again, ``unique`` whether no id repeats (else it is counted where that matters).
    """
    own = [spacing_col] if spacing_col else []
    slim = [*dict.fromkeys([*by, "point_id", *XYZ, *own])]
    pending = points.select(*slim) if written else cut_lineage(points.select(*slim))
    # points without other columns are the result themselves
    all_of = sorted(slim) == sorted(points.columns)
    kept: list[DataFrame] = []
    for i in itertools.count():  # ends: the highest of close points never stays pending
        judged = None
        if i:
            sizes = cut_lineage(pending.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1"))
            pending = pending.join(sizes, list(by)).drop("_n") if i else pending
        if not few(pending, spacing, by):
            if unique is None:
                unique = points_differ(pending, by)
            judged = thinned_once(pending, spacing, by, spacing_col) if unique else None
        if judged is None:
            near = pending.join(closest_within(pending, spacing, by, spacing_col), [*by, "point_id"], "left")
            wait = F.col("near").isNotNull()
            judged = cut_lineage(near.filter(~wait | (F.col("z") < F.col("near.z"))).select(*slim, wait.alias("_wait")))
        kept.append(judged.filter("NOT _wait").select(*(points.columns if all_of else [*by, "point_id"])))
        pending = judged.filter("_wait").select(*slim)
        if pending.isEmpty():
            break
    out = reduce(DataFrame.unionByName, kept)
    if all_of and unique:
        return out.filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in (*by, "point_id")]))
    return points.join(out.select(*by, "point_id"), [*by, "point_id"], "left_semi")


def few(points: DataFrame, spacing: float, by: tuple[str, ...]) -> bool:
    """Whether the pairs within the spacing are few enough to be made."""
    if points.count() > PAIR_ROWS:
        return False
    cells = points.groupBy(*by, *[F.floor(F.col(c) / spacing) for c in XYZ]).agg(F.count(F.lit(1)).alias("_n"))
    mates = cells.agg(F.sum(F.col("_n") * F.col("_n")) / F.sum("_n")).first()[0]
    return not mates or mates <= PAIR_MATES


def points_differ(points: DataFrame, by: tuple[str, ...]) -> bool:
    """Whether no id repeats."""
    return points.groupBy(*by, "point_id").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").isEmpty()


def jitter_copies(points: DataFrame, copies: int, mean: float = -0.025, sd: float = 0.025, seed: int = 1) -> DataFrame:
    """The original points (copy 0) and ``copies`` noisy duplicates of each."""
    out = points.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies))))
    moved = {}
    for i, c in enumerate(XYZ):
        key = F.col("point_id") * 31 + F.col("copy")
        moved[c] = F.when(F.col("copy") == 0, F.col(c)).otherwise(F.col(c) + mean + sd * id_normal(key, seed + 101 * i))
    return out.withColumns(moved)


def jitter_densify(points: DataFrame, copies: int, spacing: float, seed: int = 1) -> DataFrame:
    """Low-resolution mode: add noisy copies one set at a time, thinning after each.

    Written are the points, not their copies, which are a function of the point.
    """
    if not copies:
        return points
    points = cut_lineage(points)
    unique = points_differ(points, ("plot_id",))
    cloud = points.withColumn("point_id", F.col("point_id") * (copies + 1))
    for i in range(1, copies + 1):
        extra = jitter_copies(points, i, seed=seed).filter(F.col("copy") == i)
        extra = extra.withColumn("point_id", F.col("point_id") * (copies + 1) + i).drop("copy")
        # new ids of different points differ
        cloud = thin_min_spacing(cloud.unionByName(extra), spacing, written=True, unique=unique)
        if i < copies:
            cloud = cut_lineage(cloud)
    return cloud


# ---------------------------------------------------------------- labels and heights
def label_shift(points: DataFrame, step: int = 1) -> DataFrame:
    return points.withColumn("label", (F.col("label") + step).cast("int"))


def below_ground_filter(points: DataFrame, trim: float = 0.2) -> DataFrame:
    return points.filter(F.col("hag") > -trim)


def relabel_ground(points: DataFrame, trim: float = 0.2) -> DataFrame:
    return points.withColumn("label", F.when(F.abs("hag") < trim, F.lit(TERRAIN)).otherwise(F.col("label")))


def height_class(points: DataFrame) -> DataFrame:
    h = F.col("hag")
    return points.withColumn("height_class", F.when(h <= 0.1, 2).when(h <= 0.3, 3).when(h <= 2, 4).otherwise(5))


def split_ground_veg(points: DataFrame, veg_cutoff: float, stem_cutoff: float) -> tuple[DataFrame, DataFrame]:
    """(tall vegetation and stems, ground vegetation). Low stems move but keep their label."""
    low_veg = (F.col("label") == VEGETATION) & (F.col("hag") <= veg_cutoff)
    low_stem = (F.col("label") == STEM) & (F.col("hag") <= stem_cutoff)
    wanted = points.filter(F.col("label").isin(VEGETATION, STEM))
    ground = wanted.filter(low_veg | low_stem).withColumn(
        "label", F.when(F.col("label") == VEGETATION, F.lit(UNUSED)).otherwise(F.col("label"))
    )
    return wanted.filter(~(low_veg | low_stem)), ground


def class_counts(points: DataFrame) -> DataFrame:
    names = {TERRAIN: "n_terrain", VEGETATION: "n_vegetation", CWD: "n_cwd", STEM: "n_stem"}
    return points.groupBy("plot_id").agg(*[F.count(F.when(F.col("label") == k, 1)).alias(n) for k, n in names.items()])


def cylinder_gate(cylinders: DataFrame, minimum_cci: float, maximum_dbh: float) -> DataFrame:
    d = F.col("radius") * 2
    return cylinders.filter(((F.col("cci") >= minimum_cci) | (F.col("cci") == 0)) & (d < maximum_dbh) & (d > 0.04))


def height_normalise(points: DataFrame) -> DataFrame:
    return points.withColumn("z", half_even(F.col("hag"), 3)).filter("z >= 0")


def dbh_slice(points: DataFrame, plots: DataFrame, dbh_height: float, half: float = 0.03) -> DataFrame:
    """Stem-map points: a thin slice at breast height inside the plot circle."""
    return crop_circle(points.filter(F.abs(F.col("hag") - dbh_height) < half), plots, with_buffer=False)


def field_filter(trees: DataFrame, minimum_mm: float = 110.0) -> DataFrame:
    keep = ~(F.coalesce(F.col("dbh_mm") < minimum_mm, F.lit(False)) & F.col("field_id").isNull())
    return trees.filter(keep).withColumn("tree_number", F.coalesce("field_id", F.lit(0).cast("long"))).drop("field_id")


def final_cloud(tree_points: DataFrame, unassigned: DataFrame, plots: DataFrame) -> DataFrame:
    """Tree points plus unassigned points inside the plot circle; points of rejected
    trees (negative ids) count as unassigned. Coordinates rounded to millimetres."""
    free = unassigned.unionByName(tree_points.filter("tree_id < 0"))
    whole = tree_points.filter("tree_id >= 0").unionByName(crop_circle(free, plots, with_buffer=False))
    return whole.withColumns({c: half_even(F.col(c), 3) for c in XYZ})


def z_band(points: DataFrame, lo: float, hi: float, keep: str = "outside") -> DataFrame:
    inside = (F.col("z") >= lo) & (F.col("z") <= hi)
    return points.filter(inside if keep == "inside" else ~inside)


def bbox(points: DataFrame, columns: list[str]) -> DataFrame:
    return points.groupBy("plot_id").agg(
        *[f(c).alias(f"{c}{n}") for c in columns for f, n in ((F.min, "min"), (F.max, "max"))]
    )


def gps_summary(points: DataFrame) -> DataFrame:
    return points.groupBy("plot_id").agg(F.avg("gps_time").alias("mean_gps_time"), F.min("gps_time").alias("scan_start"))
