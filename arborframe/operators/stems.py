"""Stem slices, clusters, skeleton segments and circle fits."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arborframe.functions import geometry as geo
from arborframe.functions.numeric import half_even, id_hash
from arborframe.lineage import cut_lineage
from arborframe.operators.graph import density_clusters
from arborframe.operators.nearest import nearest_rows
from arborframe.operators.spatial import XYZ, knn_join, radius_pairs

SLICE = ("plot_id", "slice_id")
SECTORS = 36
MIN_FIT_POINTS = 20
UP = (0.0, 0.0, 1.0)


# ---------------------------------------------------------------- slices
def slice_table(stem_points: DataFrame, increment: float = 0.1, single_height: float = 10.0) -> DataFrame:
    """Per plot: slice starts as (base, count, step) of the lower and the upper tier.

    The upper tier starts ``single_height`` above the lowest stem point with a doubled step.
    """
    z = stem_points.groupBy("plot_id").agg(F.min("z").alias("h0"), F.max("z").alias("h1"))
    n1 = F.lit(int(-(-single_height // increment)))
    split = F.col("h0") + single_height
    n2 = F.when(F.col("h1") > split, F.ceil((F.col("h1") - split) / (2 * increment))).otherwise(F.lit(0)).cast("long")
    step2 = F.when(n2 > 1, (F.col("h1") - split) / (n2 - 1)).otherwise(F.lit(2 * increment))
    return z.select("plot_id", "h0", split.alias("split"), n1.cast("long").alias("n1"), (F.lit(single_height) / n1).alias("step1"), n2.alias("n2"), step2.alias("step2"))


def _slice_height(i: Column) -> Column:
    return F.when(i < F.col("n1"), F.col("h0") + i * F.col("step1")).otherwise(F.col("split") + (i - F.col("n1")) * F.col("step2"))


def slice_points(stem_points: DataFrame, increment: float = 0.1, thickness: float = 0.15, single_height: float = 10.0) -> DataFrame:
    """Overlapping z slices: start <= z < start + thickness. The slice numbers of a point
    are arithmetic on its z, so there is no range join."""
    out = stem_points.join(cut_lineage(slice_table(stem_points, increment, single_height)), "plot_id")
    none = F.expr("array(CAST(NULL AS BIGINT))")

    def span(base: str, step: str, n: str, shift: Column) -> Column:
        rel = F.col("z") - F.col(base)
        lo = F.greatest(F.floor((rel - thickness) / F.col(step)), F.lit(0).cast("long"))
        hi = F.least(F.floor(rel / F.col(step)) + 1, F.col(n) - 1)
        return F.when(lo <= hi, F.transform(F.sequence(lo, F.greatest(lo, hi)), lambda k: k + shift)).otherwise(none)

    both = F.array_compact(F.concat(span("h0", "step1", "n1", F.lit(0).cast("long")), span("split", "step2", "n2", F.col("n1"))))
    out = out.withColumn("slice_id", F.explode(both)).withColumn("slice_z", _slice_height(F.col("slice_id")))
    out = out.filter((F.col("z") >= F.col("slice_z")) & (F.col("z") < F.col("slice_z") + thickness))
    return out.select(*stem_points.columns, F.col("slice_id").cast("int").alias("slice_id"), "slice_z")


def slice_thresholds(slices: DataFrame, dtm: DataFrame, table: Sequence[int] = (100, 50, 20)) -> DataFrame:
    """Cluster size threshold per slice, stepping down with height over the lowest slice.

    The step is 5 m plus the plot's relief (99th percentile minus minimum of the terrain).
    Slices without more points than their threshold are left out.
    """
    counted = dtm.groupBy("plot_id", "z").agg(F.count(F.lit(1)).alias("_n"))
    relief = counted.groupBy("plot_id").agg((F.percentile("z", F.lit(0.99), F.col("_n")) - F.min("z")).alias("_relief"))
    per = slices.groupBy(*SLICE).agg(F.first("slice_z").alias("slice_z"), F.count(F.lit(1)).alias("n_points"))
    low = per.groupBy("plot_id").agg(F.min("slice_z").alias("_low"))
    step = F.floor((F.col("slice_z") - F.col("_low")) / (5.0 + F.coalesce("_relief", F.lit(0.0))))
    index = F.least(step, F.lit(len(table) - 1)).cast("int")
    sizes = F.array(*[F.lit(int(t)) for t in table])
    out = per.join(low, "plot_id").join(relief, "plot_id", "left")
    out = out.select(*SLICE, "slice_z", "n_points", F.element_at(sizes, index + 1).alias("threshold"))
    return out.filter(F.col("n_points") > F.col("threshold"))


def sor_filter(slices: DataFrame, k: int = 10, m: float = 0.5) -> DataFrame:
    """Statistical outlier removal per slice by the mean distance to the k nearest points."""
    near = nearest_rows(slices, slices, k, "point_id", "point_id", by=SLICE, exclude_self=True)
    mean = near.groupBy(*SLICE, "point_id").agg(F.avg("near_dist").alias("_d"))
    mean = cut_lineage(mean)
    limit = mean.groupBy(*SLICE).agg((F.avg("_d") + m * F.stddev_pop("_d")).alias("_limit"))
    out = mean.join(limit, list(SLICE)).filter(F.col("_d") > F.col("_limit")).select(*SLICE, "point_id")
    return slices.join(out, [*SLICE, "point_id"], "left_anti")


def slice_clusters(slices: DataFrame, thresholds: DataFrame, eps: float = 0.03, min_samples: int = 10, min_size: int = 40) -> DataFrame:
    """Density clusters per slice that reach the minimum size and the slice's threshold."""
    # written, so that the few rows per slice and cluster meet the points without a shuffle
    thresholds = cut_lineage(thresholds)
    used = slices.join(thresholds.select(*SLICE, "threshold"), list(SLICE))
    found = cut_lineage(density_clusters(used, eps, min_samples, "point_id", SLICE, min_size=min_size))
    sizes = found.groupBy(*SLICE, "cluster_id").agg(F.count(F.lit(1)).alias("_n")).join(thresholds.select(*SLICE, "threshold"), list(SLICE))
    good = cut_lineage(sizes.filter(F.col("_n") >= F.col("threshold")).select(*SLICE, "cluster_id"))
    named = found.join(good, [*SLICE, "cluster_id"], "left_semi")
    return slices.join(named, [*SLICE, "point_id"])


def cluster_centres(clusters: DataFrame) -> DataFrame:
    return clusters.groupBy(*SLICE, "cluster_id").agg(*[F.avg(c).alias(c) for c in XYZ])


def skeleton_segments(
    skeleton: DataFrame, dtm: DataFrame, gap: float = 0.15, single_height: float = 10.0, increment: float = 0.1, min_points: int = 5
) -> DataFrame:
    """Skeleton points linked into branches, with a doubled gap in the upper tier.

    branch_id counts the segments of a plot from the lowest up (segments, not points).
    """
    top = dtm.groupBy("plot_id").agg((F.max("z") + single_height + increment).alias("_split"))
    rows = skeleton.withColumn("skel_id", F.xxhash64(*SLICE, "cluster_id")).join(top, "plot_id")
    rows = cut_lineage(rows.withColumn("tier", (F.col("z") >= F.col("_split")).cast("int")).drop("_split"))
    by = ("plot_id", "tier")
    low = density_clusters(rows.filter("tier = 0"), gap, 2, "skel_id", by)
    high = density_clusters(rows.filter("tier = 1"), 2 * gap, 2, "skel_id", by)
    named = cut_lineage(rows.join(low.unionByName(high).withColumnRenamed("cluster_id", "_seg"), [*by, "skel_id"]))
    segs = named.groupBy(*by, "_seg").agg(F.count(F.lit(1)).alias("_n"), F.min("z").alias("_z")).filter(F.col("_n") >= min_points)
    order = Window.partitionBy("plot_id").orderBy("tier", "_z", "_seg")
    segs = segs.withColumn("branch_id", F.row_number().over(order).cast("long")).select(*by, "_seg", "branch_id")
    return named.join(segs, [*by, "_seg"]).select(*skeleton.columns, "skel_id", "branch_id")


def segment_points(clusters: DataFrame, segments: DataFrame) -> DataFrame:
    """Stem points of every branch, by the kept (slice, cluster) keys; one row per point and branch."""
    keys = segments.select(*SLICE, "cluster_id", "branch_id")
    out = clusters.join(keys, [*SLICE, "cluster_id"]).select("plot_id", "branch_id", "point_id", *XYZ)
    return out.dropDuplicates(["plot_id", "branch_id", "point_id"])


# ---------------------------------------------------------------- axes
def segment_axes(segments: DataFrame, k: int = 5, start_radius: float = 0.3) -> DataFrame:
    """Local direction and section length at every skeleton point.

    The direction is the principal axis of the k nearest points that are not lower in
    the same branch; the last k points of a branch keep the direction found just below
    them, a branch of at most k points has one direction. Directions point upwards.
    """
    by = ["plot_id", "branch_id"]
    order = Window.partitionBy(*by).orderBy("z", "skel_id")
    rows = segments.withColumn("_i", F.row_number().over(order))
    sizes = segments.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
    rows = rows.join(sizes, by).withColumn("_left", F.col("_n") - F.col("_i") + 1).select(*by, "skel_id", *XYZ, "_i", "_n", "_left")
    rows = cut_lineage(rows)

    take = [F.col(c) for c in XYZ]
    full = rows.filter((F.col("_left") > k) | ((F.col("_i") == 1) & (F.col("_n") <= k)))
    near = knn_join(full, rows, k, "skel_id", "skel_id", start_radius, by=by, take=("_i", "x", "y", "z"), condition="near._i >= _i", need="_left")
    cov = near.groupBy(*by, "skel_id").agg(
        *[F.covar_pop(a, b).alias(f"{a}{b}") for a, b in geo.MOMENTS],
        *[(F.max(c) - F.min(c)).alias(f"_e{c}") for c in XYZ],
    )
    extent = geo.norm([F.col(f"_e{c}") for c in XYZ])
    found = geo.with_axis(cov).select(*by, "skel_id", "nx", "ny", "nz", (extent / (k - 1)).alias("length"))
    found = cut_lineage(found)
    # the axis used near the top comes from the highest point that still had more than k left
    source = rows.join(found.drop("length"), [*by, "skel_id"]).groupBy(*by).agg(
        *[F.max_by(f"n{c}", "_i").alias(f"_t{c}") for c in XYZ]
    )
    # extent of the remaining points, from the top down
    down = Window.partitionBy(*by).orderBy("_i").rowsBetween(0, Window.unboundedFollowing)
    spread = geo.norm([F.max(c).over(down) - F.min(c).over(down) for c in XYZ])
    rest = rows.withColumn("_len", spread / (k - 1))
    third = rest.filter("_left = 3").select(*by, F.col("_len").alias("_len3"))
    out = rest.join(found, [*by, "skel_id"], "left").join(source, by, "left").join(third, by, "left")
    length = F.coalesce(F.col("length"), F.when(F.col("_left") <= 2, F.coalesce("_len3", "_len")).otherwise(F.col("_len")))
    return out.select(*by, "skel_id", *take, *[F.coalesce(f"n{c}", f"_t{c}").alias(f"n{c}") for c in XYZ], length.alias("length"))


def section_points(axes: DataFrame, points: DataFrame, min_nz: float = 0.7, min_points: int = MIN_FIT_POINTS) -> DataFrame:
    """Points of the slab around every near-vertical skeleton point, relative to it and
    turned so that the axis points up.

    Points meet sections through z bins of the branch, never branch-wide.
    """
    by = ["plot_id", "branch_id"]
    upright = axes.filter((F.col("nz") > min_nz) & (F.col("length") > 0))
    bin_size = 0.25
    reach = F.col("length") / (2.0 * min_nz)
    placed = upright.withColumn("_b", F.explode(F.sequence(F.floor((F.col("z") - reach) / bin_size), F.floor((F.col("z") + reach) / bin_size))))
    cloud = points.select(*by, "point_id", *[F.col(c).alias(f"p{c}") for c in XYZ], F.floor(F.col("z") / bin_size).alias("_b"))
    d = [F.col(f"p{c}") - F.col(c) for c in XYZ]
    n = [F.col(f"n{c}") for c in XYZ]
    offset = geo.norm([a * b for a, b in zip(n, d)])
    pairs = placed.join(cloud, [*by, "_b"]).filter(offset < F.col("length") / 2.0)
    flat = geo.to_vertical(d, n)
    rows = pairs.select(*by, "skel_id", "point_id", flat[0].alias("u"), flat[1].alias("v"))
    counts = rows.groupBy(*by, "skel_id").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= min_points)
    return rows.join(counts, [*by, "skel_id"], "left_semi")


# ---------------------------------------------------------------- circles
def polar_inner_shell(sections: DataFrame, by: Sequence[str], keep: int = 4) -> DataFrame:
    """Per whole degree around the section centre, points up to the ``keep``-th smallest radius."""
    angle = F.pmod(F.rint(F.degrees(F.atan2("u", "v"))), F.lit(360.0)) + F.lit(0.0)
    rows = sections.withColumn("_phi", angle).withColumn("_d", F.sqrt(F.col("u") * F.col("u") + F.col("v") * F.col("v")))
    w = Window.partitionBy(*by, "_phi").orderBy("_d")
    return rows.withColumn("_r", F.rank().over(w)).filter(F.col("_r") <= keep).drop("_phi", "_d", "_r")


def circle_candidates(points: DataFrame, by: Sequence[str], trials: int, seed: int) -> DataFrame:
    """``trials`` circles per section through three hash-picked points.

    A point finds the picks that fall on it from its place in its section, so the sections
    are shuffled once and meet no table of picks.
    """
    by = list(by)
    section = Window.partitionBy(*by)
    rows = points.filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in by])).select(
        *by, "u", "v", (F.row_number().over(section.orderBy("point_id")) - 1).alias("_i"),
        F.count(F.lit(1)).over(section).alias("n_points"), F.min("point_id").over(section).alias("_seed"),
    )

    key = F.pmod(F.col("_seed"), F.lit(1000003)) * 4099 + F.col("trial")
    here = [F.pmod(id_hash(key, seed + j), F.col("n_points")) == F.col("_i") for j in range(3)]
    picks = rows.withColumn("trial", F.explode(F.sequence(F.lit(0), F.lit(trials - 1)))).filter(here[0] | here[1] | here[2])
    at = {f"_{c}{j}": F.max(F.when(here[j], F.col(c))) for j in range(3) for c in ("u", "v")}
    picks = picks.groupBy(*by, "trial").agg(F.first("n_points").alias("n_points"), *[c.alias(n) for n, c in at.items()])
    ax, ay, bx, by_, cx, cy = [F.col(c) for c in ("_u0", "_v0", "_u1", "_v1", "_u2", "_v2")]
    d = 2.0 * (ax * (by_ - cy) + bx * (cy - ay) + cx * (ay - by_))
    sa, sb, sc = ax * ax + ay * ay, bx * bx + by_ * by_, cx * cx + cy * cy
    u = F.try_divide(sa * (by_ - cy) + sb * (cy - ay) + sc * (ay - by_), d)
    v = F.try_divide(sa * (cx - bx) + sb * (ax - cx) + sc * (bx - ax), d)
    out = picks.filter(F.abs(d) > 1e-12).select(*by, "n_points", "trial", u.alias("cu"), v.alias("cv"), ax.alias("_au"), ay.alias("_av"))
    r = F.sqrt((F.col("_au") - F.col("cu")) * (F.col("_au") - F.col("cu")) + (F.col("_av") - F.col("cv")) * (F.col("_av") - F.col("cv")))
    return out.withColumn("cr", r).drop("_au", "_av")


def circle_fit(points: DataFrame, by: Sequence[str], tolerance: float = 0.03, trials: int = 64, seed: int = 7) -> DataFrame:
    """Consensus circle per section: best candidate by inliers within ``tolerance``, then
    the algebraic least-squares circle of its inliers from moment sums.

    points(by, point_id, u, v) are an inner shell: at most a few points per degree, so
    sections are small whatever the scan density. Each point meets its section's
    ``trials`` candidates once.
    """
    by = list(by)
    cand = cut_lineage(circle_candidates(points, by, trials, seed))
    off = F.abs(F.sqrt((F.col("u") - F.col("cu")) * (F.col("u") - F.col("cu")) + (F.col("v") - F.col("cv")) * (F.col("v") - F.col("cv"))) - F.col("cr"))
    # merge joins: statistics do not see the points a view explodes, and would broadcast them
    scored = points.select(*by, "u", "v").join(cand.hint("merge"), by).withColumn("_e", off)
    votes = scored.groupBy(*by, "trial").agg(
        F.count(F.when(F.col("_e") <= tolerance, 1)).alias("_in"), half_even(F.sum(F.col("_e") * F.col("_e")), 6).alias("_sq")
    )
    w = Window.partitionBy(*by).orderBy(F.desc("_in"), "_sq", "trial")
    best = votes.withColumn("_r", F.row_number().over(w)).filter((F.col("_r") == 1) & (F.col("_in") >= 3)).select(*by, "trial")
    best = cand.join(best.hint("merge"), [*by, "trial"], "left_semi")
    inliers = points.select(*by, "u", "v").join(best.hint("merge"), by).withColumn("_e", off).filter(F.col("_e") <= tolerance)
    # moments about the candidate centre keep the 2x2 system well conditioned
    p, q = F.col("u") - F.col("cu"), F.col("v") - F.col("cv")
    w2 = p * p + q * q
    sums = inliers.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_inliers"), F.first("cu").alias("_cu"), F.first("cv").alias("_cv"),
        F.avg(p).alias("_p"), F.avg(q).alias("_q"), F.avg(w2).alias("_w"),
        F.avg(p * p).alias("_pp"), F.avg(p * q).alias("_pq"), F.avg(q * q).alias("_qq"), F.avg(p * w2).alias("_pw"), F.avg(q * w2).alias("_qw"),
    )
    spp, spq, sqq = F.col("_pp") - F.col("_p") * F.col("_p"), F.col("_pq") - F.col("_p") * F.col("_q"), F.col("_qq") - F.col("_q") * F.col("_q")
    spw, sqw = F.col("_pw") - F.col("_p") * F.col("_w"), F.col("_qw") - F.col("_q") * F.col("_w")
    det = 2.0 * (spp * sqq - spq * spq)
    a, b = F.try_divide(spw * sqq - sqw * spq, det), F.try_divide(sqw * spp - spw * spq, det)
    sums = sums.withColumns({"_a": a, "_b": b})
    radius = F.sqrt(F.col("_w") - 2.0 * (F.col("_a") * F.col("_p") + F.col("_b") * F.col("_q")) + F.col("_a") * F.col("_a") + F.col("_b") * F.col("_b"))
    return sums.filter("_a IS NOT NULL").select(
        *by, (F.col("_cu") + F.col("_a")).alias("cu"), (F.col("_cv") + F.col("_b")).alias("cv"), radius.alias("radius"), "n_inliers"
    )


def circumferential_completeness(points: DataFrame, circles: DataFrame, by: Sequence[str], mode: str = "even") -> DataFrame:
    """Share (0..100) of 36 sectors that hold a point within 0.8..1.2 radii.

    ``mode='reference'`` keeps sector directions that come from degrees read as radians.
    Sectors are bits of one number, so the aggregate is a bitwise or.
    """
    by = list(by)
    du, dv = F.col("u") - F.col("cu"), F.col("v") - F.col("cv")
    # merge joins: statistics do not see the points a view explodes, and would broadcast them
    rows = points.select(*by, "u", "v").join(circles.select(*by, "cu", "cv", "radius").hint("merge"), by)
    d = F.sqrt(du * du + dv * dv)
    ring = rows.select(*by, du.alias("du"), dv.alias("dv"), d.alias("d"), "radius").filter(
        (F.col("d") >= 0.8 * F.col("radius")) & (F.col("d") <= 1.2 * F.col("radius")) & (F.col("d") > 0)
    )
    if mode == "even":
        deg = F.degrees(F.atan2("dv", "du"))
        near = F.rint(deg / 10.0)
        ring = ring.filter(F.abs(deg - near * 10.0) < 5.0).withColumn("_k", F.pmod(near, F.lit(36.0)).cast("int"))
    else:
        ring = ring.withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(SECTORS - 1))))
        s = F.col("_k") * 10.0 - 180.0
        cos = (F.cos(s) * F.col("du") + F.sin(s) * F.col("dv")) / F.col("d")
        ring = ring.filter(F.degrees(F.acos(geo.clip(cos, -1.0, 1.0))) < 5.0)
    bit = F.expr("shiftleft(1L, _k)")
    hits = ring.groupBy(*by).agg(F.bit_count(F.bit_or(bit)).alias("_n"))
    out = circles.select(*by).join(hits.hint("merge"), by, "left")
    return out.select(*by, F.rint(F.coalesce("_n", F.lit(0)) * 100.0 / SECTORS).alias("cci"))


def fit_cylinders(axes: DataFrame, points: DataFrame, tolerance: float = 0.03, trials: int = 64, min_nz: float = 0.7) -> DataFrame:
    """Cylinders at the near-vertical skeleton points of every branch.

    Sections of at most 20 points or without a consensus keep the skeleton point with
    radius 0 and completeness 0; a failed fit also gets the vertical as its normal.
    """
    key = ["plot_id", "branch_id", "skel_id"]
    sections = cut_lineage(section_points(axes, points, min_nz))
    sizes = sections.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    enough = sizes.filter(F.col("_n") > MIN_FIT_POINTS).select(*key)
    shell = cut_lineage(polar_inner_shell(sections.join(enough, key, "left_semi"), key))
    circles = cut_lineage(circle_fit(shell, key, tolerance, trials))
    circles = circles.withColumn("radius", half_even(F.col("radius"), 2))
    cci = circumferential_completeness(shell, circles, key)
    out = axes.join(sizes, key).join(circles, key, "left").join(cci, key, "left")
    n = [F.col(f"n{c}") for c in XYZ]
    fitted = F.col("radius").isNotNull()
    turned = geo.from_vertical([F.col("cu"), F.col("cv"), F.lit(0.0)], n)
    failed = ~fitted & (F.col("_n") > MIN_FIT_POINTS)
    return out.select(
        "plot_id", "branch_id", F.col("skel_id").alias("cyl_id"),
        *[F.when(fitted, F.col(c) + t).otherwise(F.col(c)).alias(c) for c, t in zip(XYZ, turned)],
        *[F.when(failed, F.lit(v)).otherwise(a).alias(f"n{c}") for a, c, v in zip(n, XYZ, UP)],
        F.coalesce("radius", F.lit(0.0)).alias("radius"), F.coalesce("cci", F.lit(0.0)).alias("cci"),
    )


def cylinder_fit_variation(points: DataFrame, by: Sequence[str], trials: int = 50, seed: int = 11) -> DataFrame:
    """Radius, centre and error variation of a section by its principal axis.

    Under 10 points: mean position only. From 10: candidates in the plane across the
    axis; the one with the lowest variation of distance / radius among points at
    0.8..1.2 radii wins, needing a fifth of the points. points(by, point_id, x, y, z).
    """
    by = list(by)
    stats = points.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(f"m{c}") for c in XYZ],
        *[F.covar_pop(a, b).alias(f"{a}{b}") for a, b in geo.MOMENTS],
    )
    stats = cut_lineage(geo.with_axis(stats).drop(*geo.MOMENTS))
    joined = points.join(stats.filter("n >= 10 AND nx IS NOT NULL"), by)
    flat = geo.to_vertical([F.col(c) - F.col(f"m{c}") for c in XYZ], [F.col(f"n{c}") for c in XYZ])
    plane = cut_lineage(joined.select(*by, "point_id", flat[0].alias("u"), flat[1].alias("v")))
    cand = cut_lineage(circle_candidates(plane, by, trials, seed))
    err = F.sqrt((F.col("u") - F.col("cu")) * (F.col("u") - F.col("cu")) + (F.col("v") - F.col("cv")) * (F.col("v") - F.col("cv"))) / F.col("cr")
    rated = plane.join(cand, by).withColumn("_e", err).filter(F.col("_e").between(0.8, 1.2))
    score = rated.groupBy(*by, "trial").agg(
        F.count(F.lit(1)).alias("_in"), (F.stddev_pop("_e") / F.avg("_e")).alias("cv_error"), F.first("n_points").alias("_n"),
        F.first("cr").alias("radius"), F.first("cu").alias("cu"), F.first("cv").alias("cv"),
    )
    w = Window.partitionBy(*by).orderBy(half_even(F.col("cv_error"), 9), "trial")
    best = score.filter(F.col("_in") >= 0.2 * F.col("_n")).withColumn("_r", F.row_number().over(w)).filter("_r = 1")
    out = stats.join(best.select(*by, "cv_error", "radius", "cu", "cv"), by, "left")
    back = geo.from_vertical([F.col("cu"), F.col("cv"), F.lit(0.0)], [F.col(f"n{c}") for c in XYZ])
    return out.select(
        *by, "radius", *[F.when(F.col("radius").isNotNull(), F.col(f"m{c}") + t).otherwise(F.col(f"m{c}")).alias(c) for c, t in zip(XYZ, back)],
        F.col("cv_error").alias("cv"), "n",
    )


def smooth_cylinders(cylinders: DataFrame, k: int = 7) -> DataFrame:
    """Per tree, medians (radius, xy, normal) and mean completeness of the k nearest cylinders.

    Cylinders at one position have the same neighbours, which are searched once. Rows that
    repeat an id have the k nearest of all their pairs.
    """
    by = ["plot_id", "tree_id"]
    attrs = ("radius", "x", "y", "nx", "ny", "nz", "cci")
    at = F.struct(*XYZ).alias("_at")
    spots = cut_lineage(cylinders.select(*by, *XYZ).distinct()).select("*", at)
    near = cut_lineage(nearest_rows(spots, cylinders, k, "_at", "cyl_id", by=by, take=attrs))

    def smoothed(rows: DataFrame, key: str) -> DataFrame:
        return cut_lineage(rows.groupBy(*by, key).agg(*[F.percentile(c, F.lit(0.5)).alias(c) for c in attrs[:-1]], F.avg("cci").alias("cci")))

    rows = cylinders.filter("cyl_id IS NOT NULL").select(*[c for c in cylinders.columns if c not in attrs], at)
    repeated = cut_lineage(rows.groupBy(*by, "cyl_id").agg(F.count(F.lit(1)).alias("_m")).filter("_m > 1").drop("_m"))
    once = rows.join(repeated, [*by, "cyl_id"], "left_anti").join(smoothed(near, "_at").hint("merge"), [*by, "_at"]).select(*cylinders.columns)
    if repeated.isEmpty():
        return once
    again = rows.join(repeated, [*by, "cyl_id"], "left_semi")
    nth = Window.partitionBy(*by, "cyl_id").orderBy("near_dist", "near_id")
    pairs = again.select(*by, "cyl_id", "_at").join(near.hint("merge"), [*by, "_at"]).withColumn("_r", F.row_number().over(nth))
    return once.unionByName(again.join(smoothed(pairs.filter(F.col("_r") <= k), "cyl_id").hint("merge"), [*by, "cyl_id"]).select(*cylinders.columns))
