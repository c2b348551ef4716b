"""Overlapping boxes, voxels and training-sample preparation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arborframe.functions.numeric import HASH_P2, half_even, id_hash, id_normal, id_uniform
from arborframe.lineage import cut_lineage
from arborframe.operators.clean import plot_extent, thin_min_spacing
from arborframe.operators.spatial import XYZ

BUCKETS = 256


# ---------------------------------------------------------------- boxes
def box_axes(points: DataFrame, size: float = 6.0, overlap: float = 0.5) -> DataFrame:
    """Per plot and axis: origin, spacing of box centres and number of centres."""
    box = plot_extent(points)
    cols = []
    for c in XYZ:
        n = F.ceil((F.col(f"max_{c}") - F.col(f"min_{c}")) / size)
        steps = (F.floor(n / (1.0 - overlap)) + 1).cast("long")
        step = F.when(steps > 1, n * size / (steps - 1)).otherwise(F.lit(float(size)))
        cols += [F.col(f"min_{c}").alias(f"o_{c}"), steps.alias(f"n_{c}"), step.alias(f"s_{c}")]
    return box.select("plot_id", *cols)


def _box_id(ix: Column, iy: Column, iz: Column) -> Column:
    return ((ix * F.col("n_y") + iy) * F.col("n_z") + iz).cast("long")


def box_grid(points: DataFrame, size: float = 6.0, overlap: float = 0.5) -> DataFrame:
    out = box_axes(points, size, overlap)
    for c in XYZ:
        out = out.withColumn(f"i_{c}", F.explode(F.sequence(F.lit(0).cast("long"), F.col(f"n_{c}") - 1)))
    return out.select(
        "plot_id",
        _box_id(F.col("i_x"), F.col("i_y"), F.col("i_z")).alias("box_id"),
        *[(F.col(f"o_{c}") + F.col(f"i_{c}") * F.col(f"s_{c}")).alias(f"c{c}") for c in XYZ],
    )


def assign_boxes(points: DataFrame, size: float = 6.0, overlap: float = 0.5) -> DataFrame:
    """Every (box, point) with centre - size/2 <= p < centre + size/2 on each axis.

    The box index range is arithmetic on the point, so no join with the boxes is needed.
    """
    out = points.join(cut_lineage(box_axes(points, size, overlap)), "plot_id")
    half = size / 2.0
    for c in XYZ:
        rel = F.col(c) - F.col(f"o_{c}")
        lo = F.greatest(F.floor((rel - half) / F.col(f"s_{c}")), F.lit(0).cast("long"))
        hi = F.least(F.floor((rel + half) / F.col(f"s_{c}")) + 1, F.col(f"n_{c}") - 1)
        centre = F.col(f"o_{c}") + F.col(f"i_{c}") * F.col(f"s_{c}")
        out = out.filter(lo <= hi).withColumn(f"i_{c}", F.explode(F.sequence(lo, hi)))
        out = out.filter((F.col(c) >= centre - half) & (F.col(c) < centre + half))
    return out.select(*points.columns, _box_id(F.col("i_x"), F.col("i_y"), F.col("i_z")).alias("box_id"))


def chunk_corner_boxes(points: DataFrame, size: float = 6.0, step: float = 3.0) -> DataFrame:
    """Corner-based variant on mean-shifted coordinates, both box borders inclusive."""
    mean = points.groupBy("plot_id").agg(*[F.avg(c).alias(f"m_{c}") for c in XYZ])
    moved = points.join(cut_lineage(mean), "plot_id").withColumns({c: F.col(c) - F.col(f"m_{c}") for c in XYZ}).select(*points.columns)
    axes = plot_extent(moved).select(
        "plot_id",
        *[(F.floor(F.col(f"min_{c}")) - step).alias(f"o_{c}") for c in XYZ],
        *[F.ceil((F.ceil(F.col(f"max_{c}")) + step - F.floor(F.col(f"min_{c}")) + step) / step).cast("long").alias(f"n_{c}") for c in XYZ],
    )
    out = moved.join(cut_lineage(axes), "plot_id")
    for c in XYZ:
        rel = F.col(c) - F.col(f"o_{c}")
        lo = F.greatest(F.floor((rel - size) / step), F.lit(0).cast("long"))
        hi = F.least(F.floor(rel / step) + 1, F.col(f"n_{c}") - 1)
        corner = F.col(f"o_{c}") + F.col(f"i_{c}") * step
        out = out.withColumn(f"i_{c}", F.explode(F.sequence(lo, hi))).filter(F.col(c).between(corner, corner + size))
    return out.select(*points.columns, _box_id(F.col("i_x"), F.col("i_y"), F.col("i_z")).alias("box_id"))


def box_min_points(samples: DataFrame, minimum: int = 1000) -> DataFrame:
    """Drop boxes with at most ``minimum`` points; counts are combined before the shuffle."""
    # the few rows per box are written, so that the samples need no shuffle to meet them
    sizes = cut_lineage(samples.groupBy("plot_id", "box_id").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > minimum))
    return samples.join(sizes, ["plot_id", "box_id"], "left_semi")


def box_cap(samples: DataFrame, cap: int, seed: int = 1) -> DataFrame:
    """Random ``cap`` points per box in id-hash order.

    The hash range is cut into equal buckets; bucket counts (combined before the shuffle)
    show in which bucket a box reaches its cap. Points of later buckets are filtered out
    without a sort, so a box that holds much of the data is cut to little more than its
    cap before it is ranked.
    """
    key = ["plot_id", "box_id"]
    rows = samples.withColumn("_h", id_hash(F.col("point_id"), seed))
    rows = rows.withColumn("_b", F.floor(F.col("_h") / (HASH_P2 / BUCKETS)).cast("int"))
    counts = rows.groupBy(*key, "_b").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(*key).orderBy("_b")) - F.col("_n")
    last = counts.withColumn("_before", before).filter(F.col("_before") < cap).groupBy(*key).agg(F.max("_b").alias("_last"))
    kept = rows.join(cut_lineage(last), key).filter(F.col("_b") <= F.col("_last"))
    rank = F.row_number().over(Window.partitionBy(*key).orderBy("_h", "point_id"))
    return kept.withColumn("_r", rank).filter(F.col("_r") <= cap).select(*samples.columns)


def local_shift(samples: DataFrame) -> DataFrame:
    """Shift each box by its rounded mean; the shift columns allow adding it back."""
    mean = samples.groupBy("plot_id", "box_id").agg(*[half_even(half_even(F.avg(c), 9)).alias(f"d{c}") for c in XYZ])
    out = samples.join(cut_lineage(mean), ["plot_id", "box_id"])
    return out.withColumns({c: F.col(c) - F.col(f"d{c}") for c in XYZ})


# ---------------------------------------------------------------- voxels
def voxelise(points: DataFrame, length: float, use_z: bool = True) -> DataFrame:
    axes = XYZ if use_z else XYZ[:2]
    return points.withColumns({f"v{c}": F.floor(F.col(c) / length) * length for c in axes})


def voxel_first(points: DataFrame, length: float) -> DataFrame:
    w = Window.partitionBy("plot_id", "vx", "vy", "vz").orderBy("point_id")
    return voxelise(points, length).withColumn("_r", F.row_number().over(w)).filter("_r = 1").select(*points.columns)


def voxel_medoid(points: DataFrame, length: float, flag: bool = False) -> DataFrame:
    """Point nearest to the voxel's median position (lowest id on ties)."""
    keys = ["plot_id", "vx", "vy", "vz"]
    vox = voxelise(points, length)
    mid = vox.groupBy(*keys).agg(*[F.percentile(c, F.lit(0.5)).alias(f"m{c}") for c in XYZ])
    d = [F.col(c) - F.col(f"m{c}") for c in XYZ]
    near = vox.join(mid, keys).withColumn("_d", F.sqrt(d[0] * d[0] + d[1] * d[1] + d[2] * d[2]))
    w = Window.partitionBy(*keys).orderBy(half_even(F.col("_d"), 9), "point_id")
    if flag:
        first = near.withColumn("_r", F.row_number().over(w)).filter("_r = 1").select("plot_id", "point_id", F.lit(True).alias("downsample"))
        return points.join(first, ["plot_id", "point_id"], "left").withColumn("downsample", F.coalesce("downsample", F.lit(False)))
    return near.withColumn("_r", F.row_number().over(w)).filter("_r = 1").select(*points.columns)


# ---------------------------------------------------------------- samples
def split_train_val_test(points: DataFrame) -> DataFrame:
    """Lower half trains, upper left validates, upper right tests (first match wins)."""
    box = plot_extent(points).select(
        "plot_id",
        ((F.col("min_x") + F.col("max_x")) / 2.0).alias("_mx"),
        ((F.col("min_y") + F.col("max_y")) / 2.0).alias("_my"),
    )
    part = F.when(F.col("y") <= F.col("_my"), "train").when(F.col("x") <= F.col("_mx"), "validation").otherwise("test")
    return points.join(cut_lineage(box), "plot_id").withColumn("split", part).select(*points.columns, "split")


def sample_accuracy(samples: DataFrame) -> DataFrame:
    """Mean over boxes of the share of right labels."""
    right = (F.col("label") == F.col("pred")).cast("double")
    per_box = samples.groupBy("plot_id", "box_id").agg(F.avg(right).alias("_a"))
    return per_box.groupBy("plot_id").agg(F.avg("_a").alias("accuracy"))


def _rotated(x: Column, y: Column, z: Column, a: Column, b: Column, c: Column) -> list[Column]:
    """Row vector times roll(a), pitch(b), yaw(c), angles in radians."""
    y, z = y * F.cos(a) + z * F.sin(a), z * F.cos(a) - y * F.sin(a)
    x, z = x * F.cos(b) - z * F.sin(b), x * F.sin(b) + z * F.cos(b)
    x, y = x * F.cos(c) + y * F.sin(c), y * F.cos(c) - x * F.sin(c)
    return [x, y, z]


def augment(samples: DataFrame, seed: int = 1, min_points: int = 1000, small_tilt: float = 25.0, thin: bool = True) -> DataFrame:
    """Random rotation, scale, thinning, removal and noise per box, from id hashes.

    Labels: 0 terrain, 1 vegetation, 2 CWD, 3 stem. Boxes without terrain and CWD may
    turn freely; in boxes without terrain CWD becomes stem. Input boxes are capped by
    ``box_cap``, which bounds the per-box rank used for point removal.
    """
    box_key = ["plot_id", "box_id"]
    key = F.pmod(F.xxhash64("plot_id", "box_id"), F.lit(2**31 - 1))
    facts = samples.groupBy(*box_key).agg(
        F.min(F.when(F.col("label") == 0, 0).otherwise(1)).alias("_no_ground"),
        F.min(F.when(F.col("label") == 2, 0).otherwise(1)).alias("_no_cwd"),
        F.count(F.lit(1)).alias("_n"),
    )
    free = (F.col("_no_ground") == 1) & (F.col("_no_cwd") == 1)
    tilt = F.when(free, 90.0).otherwise(small_tilt)
    facts = facts.withColumns({f"_u{i}": id_uniform(key, seed + 211 * i) for i in range(10)})
    box = facts.select(
        *box_key, "_no_ground", "_u6", "_u7",
        *[F.radians((F.col(f"_u{i}") * 2 - 1) * t).alias(f"_a{i}") for i, t in enumerate((tilt, tilt, F.lit(180.0)))],
        (0.8 + 0.4 * F.col("_u3")).alias("_scale"),
        F.when(F.col("_u4") >= 0.5, 0.01 + 0.015 * F.col("_u5")).otherwise(0.0).alias("_noise"),
        F.when((F.col("_u8") >= 0.5) & (F.col("_n") > min_points), 0.01 + 0.015 * F.col("_u9")).otherwise(0.0).alias("_spacing"),
    )
    rows = samples.join(cut_lineage(box), box_key)
    turned = _rotated(*[F.col(c) for c in XYZ], *[F.col(f"_a{i}") for i in range(3)])
    rows = rows.withColumns({c: p * F.col("_scale") for c, p in zip(XYZ, turned)})
    if thin:
        rows = cut_lineage(rows)
        loose = rows.filter("_spacing > 0")
        thinned = cut_lineage(thin_min_spacing(loose, 0.025, tuple(box_key), "_spacing"))
        enough = cut_lineage(thinned.groupBy(*box_key).agg(F.count(F.lit(1)).alias("_m")).filter(F.col("_m") >= min_points))
        kept = thinned.join(enough, box_key, "left_semi")
        rows = kept.unionByName(rows.join(enough, box_key, "left_anti"))
    sizes = rows.groupBy(*box_key).agg(F.count(F.lit(1)).alias("_n"))
    rank = F.row_number().over(Window.partitionBy(*box_key).orderBy(id_hash(F.col("point_id"), seed + 5), "point_id"))
    quota = F.when(
        (F.col("_u6") >= 0.8) & (F.col("_n") > min_points),
        min_points + F.floor(F.col("_u7") * 0.95 * (F.col("_n") - min_points)),
    ).otherwise(F.col("_n"))
    rows = rows.join(cut_lineage(sizes), box_key).withColumn("_r", rank).filter(F.col("_r") <= quota)
    moved = {c: F.col(c) + F.col("_noise") * id_normal(F.col("point_id"), seed + 31 * (i + 1)) for i, c in enumerate(XYZ)}
    moved["label"] = F.when((F.col("_no_ground") == 1) & (F.col("label") == 2), F.lit(3)).otherwise(F.col("label"))
    return rows.withColumns(moved).select(*samples.columns)
