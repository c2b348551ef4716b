"""Terrain grids, heights above ground, hulls, cover and slope."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arborframe.functions import geometry as geo
from arborframe.functions.numeric import half_even
from arborframe.lineage import cut_lineage
from arborframe.operators.nearest import nearest_rows
from arborframe.operators.spatial import XY, radius_pairs

MIN_HITS = 100
TERRAIN_Q, ALL_POINTS_Q = 0.2, 0.025


# ---------------------------------------------------------------- terrain grid
def grid_nodes(points: DataFrame, resolution: float, margin: float = 3.0) -> DataFrame:
    """Regular nodes over each plot's whole-metre bounding box plus ``margin``."""
    box = points.groupBy("plot_id").agg(
        *[(F.floor(F.min(c)) - margin).alias(f"lo_{c}") for c in XY],
        *[(F.ceil(F.max(c)) + margin).alias(f"hi_{c}") for c in XY],
    )
    for c in XY:
        n = F.ceil((F.col(f"hi_{c}") - F.col(f"lo_{c}")) / resolution).cast("long")
        box = box.withColumn(f"n_{c}", n).withColumn(f"g{c}", F.explode(F.sequence(F.lit(0).cast("long"), n)))
    at = [
        (F.col(f"lo_{c}") + F.col(f"g{c}") * (F.col(f"hi_{c}") - F.col(f"lo_{c}")) / F.col(f"n_{c}")).alias(c) for c in XY
    ]
    node = (F.col("gx") * (F.col("n_y") + 1) + F.col("gy")).alias("node_id")
    return box.select("plot_id", node, "gx", "gy", *at)


def _quantile_z(pairs: DataFrame, q: float) -> DataFrame:
    """z quantile per node. Equal z values are counted first, so the percentile buffer
    holds distinct heights, not points."""
    counted = pairs.groupBy("plot_id", "node_id", "z").agg(F.count(F.lit(1)).alias("_n"))
    return counted.groupBy("plot_id", "node_id").agg(F.percentile("z", F.lit(q), F.col("_n")).alias("z"))


def ground_heights(nodes: DataFrame, terrain: DataFrame, points: DataFrame, resolution: float = 0.5) -> DataFrame:
    """Ground z of every node from an adaptive search radius.

    Terrain points within 3..6 grid steps, growing while at most 100 hits; with fewer
    than 100 hits all points, growing without bound until more than 100 are found or
    the plot has no more. Most nodes settle at the first radius; only the others meet
    the wider joins.
    """
    def hits(rows: DataFrame, cloud: DataFrame, r: float) -> DataFrame:
        near = rows.select("plot_id", "node_id", *XY)
        pairs = radius_pairs(cloud.select("plot_id", *XY, "z"), near, r, XY)
        return pairs.select("plot_id", F.col("near.node_id").alias("node_id"), "z", "dist")

    steps = [resolution * k for k in (3, 4, 5, 6)]
    nodes = cut_lineage(nodes)
    key = ["plot_id", "node_id"]

    first = hits(nodes, terrain, steps[0])
    dense = first.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > MIN_HITS).select(*key)
    dense = cut_lineage(dense)
    done = [_quantile_z(first.join(dense, key, "left_semi"), TERRAIN_Q)]
    rest = nodes.join(dense, key, "left_anti")

    wide = hits(rest, terrain, steps[-1])
    within = [F.count(F.when(F.col("dist") <= r, 1)) for r in steps]
    radius = F.lit(steps[-1])
    count = within[-1]
    for r, n in list(zip(steps, within))[-2::-1]:
        radius = F.when(n > MIN_HITS, F.lit(r)).otherwise(radius)
        count = F.when(n > MIN_HITS, n).otherwise(count)
    chosen = wide.groupBy(*key).agg(radius.alias("_r"), count.alias("_n")).filter(F.col("_n") >= MIN_HITS)
    chosen = cut_lineage(chosen)
    done.append(_quantile_z(wide.join(chosen, key).filter(F.col("dist") <= F.col("_r")), TERRAIN_Q))

    rest = cut_lineage(rest.join(chosen, key, "left_anti"))
    totals = cut_lineage(points.groupBy("plot_id").agg(F.count(F.lit(1)).alias("_total")))
    reach = steps[-1]
    rank = Window.partitionBy(*key).orderBy("dist")
    while not rest.isEmpty():
        pairs = hits(rest, points, reach)
        # distance of hit number 101 fixes the first radius step that holds it
        kth = pairs.withColumn("_k", F.row_number().over(rank)).filter(F.col("_k") <= MIN_HITS + 1)
        kth = kth.groupBy(*key).agg(F.max("dist").alias("_d"), F.count(F.lit(1)).alias("_n")).join(totals, "plot_id")
        settled = kth.filter((F.col("_n") > MIN_HITS) | (F.col("_n") == F.col("_total")))
        grown = F.ceil((F.col("_d") - steps[-1]) / resolution) * resolution + steps[-1]
        settled = cut_lineage(settled.select(*key, F.greatest(grown, F.lit(steps[-1])).alias("_r")))
        done.append(_quantile_z(pairs.join(settled, key).filter(F.col("dist") <= F.col("_r")), ALL_POINTS_Q))
        done[-1] = cut_lineage(done[-1])
        rest = cut_lineage(rest.join(settled, key, "left_anti").join(totals.select("plot_id"), "plot_id", "left_semi"))
        reach *= 2.0
    return nodes.join(reduce(DataFrame.unionByName, done), key)


def make_dtm(points: DataFrame, plots: DataFrame | None = None, resolution: float = 0.5, crop_to_points: bool = False) -> DataFrame:
    """Terrain grid from labelled points, cropped to the plot circle when plots are given."""
    from arborframe.operators.clean import TERRAIN, crop_circle

    terrain = points.filter(F.col("label") == TERRAIN)
    dtm = ground_heights(grid_nodes(terrain, resolution), terrain, points, resolution)
    if plots is not None:
        return crop_circle(dtm, plots, inclusive=True)
    if crop_to_points:
        touched = radius_pairs(points.select("plot_id", *XY), dtm.select("plot_id", "node_id", *XY), resolution, XY)
        ids = touched.select("plot_id", F.col("near.node_id").alias("node_id")).distinct()
        return dtm.join(ids, ["plot_id", "node_id"], "left_semi")
    return dtm


def _row_gap(row: pd.DataFrame) -> pd.DataFrame:
    """Greatest chessboard distance of a raster row's cells to a valued cell, from their distances along the columns."""
    up = row.sort_values("cx")["gap"].to_numpy()
    best = up.copy()
    step = 1
    while step < len(up) and step < best.max():  # further columns are at least a step away
        np.minimum(best[step:], np.maximum(up[:-step], step), out=best[step:])
        np.minimum(best[:-step], np.maximum(up[step:], step), out=best[:-step])
        step += 1
    return pd.DataFrame({"plot_id": row["plot_id"].iloc[:1], "half": [int(best.max())]})


def gap_width(raster: DataFrame, value: DataFrame) -> DataFrame:
    """(plot_id, half): the least half width (1 or more) at which a window around any cell holds a valued cell.

    Chessboard distance transform in two passes, whatever the width: distances along raster
    columns by two running windows, then along the rows, one row per group. A mirrored cell is
    never nearer than the cell itself, so the mirrored edge does not matter here.
    """
    cells = raster.select("plot_id", "cx", "cy").join(value.select("plot_id", "cx", "cy", F.col("cy").alias("_at")), ["plot_id", "cx", "cy"], "left")
    column = Window.partitionBy("plot_id", "cx").orderBy("cy")
    before = F.last("_at", True).over(column.rowsBetween(Window.unboundedPreceding, 0))
    after = F.first("_at", True).over(column.rowsBetween(0, Window.unboundedFollowing))
    # a column without values is farther than any raster is wide
    gap = F.coalesce(F.least(F.col("cy") - before, after - F.col("cy")), F.lit(2**62)).cast("long")
    of_rows = cells.select("plot_id", "cy", "cx", gap.alias("gap")).groupBy("plot_id", "cy")
    kind = raster.schema["plot_id"].dataType.simpleString()
    rows = of_rows.applyInPandas(_row_gap, f"plot_id {kind}, half long")
    return rows.groupBy("plot_id").agg(F.greatest(F.max("half"), F.lit(1).cast("long")).alias("half"))


def make_dem(points: DataFrame, length: float = 0.5, terrain_label: int = 1) -> DataFrame:
    """Cell raster of ground heights with gaps closed by a median window.

    A cell has a value only if a terrain point equals the cell's median z. The window
    (3, 5, ... cells, mirrored at the raster edge) is the smallest that leaves no gap
    in the plot; every cell takes the window median of the original values.
    """
    cells = points.withColumn("cx", F.floor(F.col("x") / length)).withColumn("cy", F.floor(F.col("y") / length))
    ground = cells.filter(F.col("label") == terrain_label)
    mid = ground.groupBy("plot_id", "cx", "cy").agg(F.percentile("z", F.lit(0.5)).alias("_m"))
    value = (
        ground.join(mid, ["plot_id", "cx", "cy"])
        .groupBy("plot_id", "cx", "cy")
        .agg(F.max(F.when(F.col("z") == F.col("_m"), F.col("z"))).alias("v"))
        .filter("v IS NOT NULL")
    )
    value = cut_lineage(value)
    box = cells.groupBy("plot_id").agg(
        *[f(c).alias(f"{n}_{c}") for c in ("cx", "cy") for f, n in ((F.min, "lo"), (F.max, "hi"))]
    )
    raster = box.join(value.select("plot_id").distinct(), "plot_id")
    for c in ("cx", "cy"):
        raster = raster.withColumn(c, F.explode(F.sequence(F.col(f"lo_{c}"), F.col(f"hi_{c}"))))
    raster = cut_lineage(raster)

    rows = raster.join(gap_width(raster, value), "plot_id")
    for c in ("cx", "cy"):
        n = F.col(f"hi_{c}") - F.col(f"lo_{c}") + 1
        rows = rows.withColumn("_o", F.explode(F.sequence(-F.col("half"), F.col("half"))))
        i = F.pmod(F.col(c) - F.col(f"lo_{c}") + F.col("_o"), 2 * n)
        rows = rows.withColumn(f"w{c}", F.least(i, 2 * n - 1 - i) + F.col(f"lo_{c}")).drop("_o")
    seen = rows.join(value.withColumnsRenamed({"cx": "wcx", "cy": "wcy"}), ["plot_id", "wcx", "wcy"])
    out = seen.groupBy("plot_id", "cx", "cy").agg(F.percentile("v", F.lit(0.5)).alias("zz"))
    return out.select("plot_id", (F.col("cx") * length).alias("xx"), (F.col("cy") * length).alias("yy"), "zz")


def dem_map(points: DataFrame, dem: DataFrame, length: float = 0.5, how: str = "left") -> DataFrame:
    """Height of each point above its DEM cell (equi-join on the cell)."""
    keyed = points.withColumn("xx", F.floor(F.col("x") / length) * length).withColumn("yy", F.floor(F.col("y") / length) * length)
    return keyed.join(dem, ["plot_id", "xx", "yy"], how).withColumn("n_z", F.col("z") - F.col("zz"))


# ---------------------------------------------------------------- heights
def lattice(dtm: DataFrame, resolution: float) -> DataFrame:
    """Origin ``_o``, spacing ``_s`` per axis and plot, written: from the node indices gx, gy where
    the grid has them, else from its least coordinates and ``resolution``."""
    facts = []
    for c in XY:
        if f"g{c}" in dtm.columns:
            wide = F.max(f"g{c}") - F.min(f"g{c}")
            step = F.when(wide > 0, (F.max(c) - F.min(c)) / wide).otherwise(F.lit(float(resolution)))
            facts += [(F.min(c) - F.min(f"g{c}") * step).alias(f"_o{c}"), step.alias(f"_s{c}")]
        else:
            facts += [F.min(c).alias(f"_o{c}"), F.lit(float(resolution)).alias(f"_s{c}")]
    return cut_lineage(dtm.groupBy("plot_id").agg(*facts))


def on_lattice(rows: DataFrame, facts: DataFrame) -> DataFrame:
    """Rows with their place ``_px``, ``_py`` in units of the plot's grid (null without a grid)."""
    return rows.join(facts, "plot_id", "left").withColumns({f"_p{c}": (F.col(c) - F.col(f"_o{c}")) / F.col(f"_s{c}") for c in XY}).drop("_ox", "_oy", "_sx", "_sy")


def hag_nearest(points: DataFrame, dtm: DataFrame, resolution: float, row_id: str = "point_id") -> DataFrame:
    """z above the nearest terrain node. Points whose rounded place on the plot's own grid
    (any origin and spacing) has a node join on it; the others, outside a cropped grid or
    on nodes that form no grid, search by the cell index."""
    facts = lattice(dtm, resolution)
    near = {f"_i{c}": F.rint(f"_p{c}").cast("long") for c in XY}
    nodes = on_lattice(dtm.select("plot_id", *XY, F.col("z").alias("_ground")), facts).withColumns(near)
    off = F.greatest(*[F.abs(F.col(f"_p{c}") - F.col(f"_i{c}")) for c in XY])
    loose = cut_lineage(nodes.groupBy("plot_id").agg(F.max(off).alias("_off")).filter("_off > 0.001").select("plot_id"))
    grid = nodes.join(loose, "plot_id", "left_anti").groupBy("plot_id", "_ix", "_iy").agg(F.min("_ground").alias("_ground"))
    placed = on_lattice(points, facts).withColumns(near).join(grid, ["plot_id", "_ix", "_iy"], "left").select(*points.columns, "_ground")
    hit = placed.filter(F.col("_ground").isNotNull())
    missed = placed.filter(F.col("_ground").isNull()).drop("_ground")
    nodes = nodes.select("plot_id", *XY, "_ground", F.xxhash64("x", "y").alias("_node"))
    found = nearest_rows(missed, nodes, 1, row_id, "_node", XY, take=("_ground",)).select("plot_id", row_id, "_ground")
    whole = hit.unionByName(missed.join(found, ["plot_id", row_id]))
    return whole.withColumn("hag", F.col("z") - F.col("_ground")).drop("_ground")


def hag_linear(rows: DataFrame, dtm: DataFrame, resolution: float) -> DataFrame:
    """z above the ground, linear on triangles of the plot's own grid.

    A cell is split along the diagonal from its lower left node; where a node of that
    diagonal is missing, along the other one. The plot's median ground height fills
    triangles without all three nodes.
    """
    facts = lattice(dtm, resolution)
    cell_of = {f"_i{c}": F.floor(f"_p{c}").cast("long") for c in XY}
    base = on_lattice(rows, facts).withColumns(cell_of).withColumns({f"_t{c}": F.col(f"_p{c}") - F.col(f"_i{c}") for c in XY}).drop("_px", "_py")
    node = on_lattice(dtm.select("plot_id", *XY, "z"), facts).select("plot_id", *[F.rint(f"_p{c}").cast("long").alias(f"_i{c}") for c in XY], "z")
    # one shuffle: each node is copied to the four cells it bounds
    corner = node.withColumn("_dx", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn("_dy", F.explode(F.array(F.lit(0), F.lit(1))))
    cells = corner.groupBy("plot_id", (F.col("_ix") - F.col("_dx")).alias("_ix"), (F.col("_iy") - F.col("_dy")).alias("_iy")).agg(
        *[F.max(F.when((F.col("_dx") == a) & (F.col("_dy") == b), F.col("z"))).alias(f"_z{a}{b}") for a in (0, 1) for b in (0, 1)]
    )
    fill = dtm.groupBy("plot_id").agg(F.percentile("z", F.lit(0.5)).alias("_median"))
    tx, ty, z00, z10, z01, z11 = (F.col(c) for c in ("_tx", "_ty", "_z00", "_z10", "_z01", "_z11"))
    # the other diagonal only where the first one lacks a node
    ground = F.when(z00.isNotNull() & z11.isNotNull(), F.when(tx >= ty, z00 + tx * (z10 - z00) + ty * (z11 - z10)).otherwise(z00 + ty * (z01 - z00) + tx * (z11 - z01))).otherwise(
        F.when(tx + ty <= 1, z00 + tx * (z10 - z00) + ty * (z01 - z00)).otherwise(z11 + (1 - tx) * (z01 - z11) + (1 - ty) * (z10 - z11))
    )
    out = base.join(cells, ["plot_id", "_ix", "_iy"], "left").join(fill, "plot_id", "left")
    return out.select(*rows.columns, (F.col("z") - F.coalesce(ground, F.col("_median"))).alias("hag"))


# ---------------------------------------------------------------- hull and area
def _chain(xy: np.ndarray) -> np.ndarray:
    """Convex hull (counter-clockwise, no collinear points) of an n x 2 array."""
    pts = np.unique(xy, axis=0)
    if len(pts) < 3:
        return pts

    def half(seq: np.ndarray) -> list[np.ndarray]:
        out: list[np.ndarray] = []
        for p in seq:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (p[1] - out[-2][1]) - (out[-1][1] - out[-2][1]) * (p[0] - out[-2][0]) <= 0:
                out.pop()
            out.append(p)
        return out

    lower, upper = half(pts), half(pts[::-1])
    return np.array(lower[:-1] + upper[:-1])


def convex_hull(points: DataFrame) -> DataFrame:
    """Hull vertices per plot, counter-clockwise.

    Points are first cut to the two extremes per exact x (combined before the shuffle),
    then to partial hulls per partition; only those few points reach the final merge.
    """
    by_x = points.groupBy("plot_id", "x").agg(F.min("y").alias("_lo"), F.max("y").alias("_hi"))
    slim = by_x.select("plot_id", "x", F.explode(F.array("_lo", "_hi")).alias("y"))
    kind = dict(slim.dtypes)["plot_id"]

    def partial(batches):
        for pdf in batches:
            for plot, g in pdf.groupby("plot_id"):
                h = _chain(g[["x", "y"]].to_numpy())
                yield pd.DataFrame({"plot_id": plot, "x": h[:, 0], "y": h[:, 1]})

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        h = _chain(pdf[["x", "y"]].to_numpy())
        return pd.DataFrame({"plot_id": pdf["plot_id"].iloc[0], "vertex": np.arange(len(h)), "x": h[:, 0], "y": h[:, 1]})

    some = slim.mapInPandas(partial, f"plot_id {kind}, x double, y double")
    return some.groupBy("plot_id").applyInPandas(merge, f"plot_id {kind}, vertex long, x double, y double")


def hull_area(hull: DataFrame) -> DataFrame:
    """Shoelace area per plot."""
    w = Window.partitionBy("plot_id").orderBy("vertex")
    whole = Window.partitionBy("plot_id").orderBy("vertex").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    nxt = {c: F.coalesce(F.lead(c).over(w), F.first(c).over(whole)) for c in XY}
    edges = hull.select("plot_id", "x", "y", nxt["x"].alias("_x2"), nxt["y"].alias("_y2"))
    return edges.groupBy("plot_id").agg((F.sum(F.col("x") * F.col("_y2") - F.col("_x2") * F.col("y")) / 2.0).alias("hull_area"))


def inside_hull(rows: DataFrame, hull: DataFrame, tolerance: float = 1e-5) -> DataFrame:
    """Rows inside the plot's hull. The hull travels as one small array per plot."""
    ring = hull.groupBy("plot_id").agg(F.array_sort(F.collect_list(F.struct("vertex", "x", "y"))).alias("_ring"))
    joined = rows.join(ring, "plot_id")
    size = F.size("_ring")

    def outside(v: Column, i: Column) -> Column:
        n = F.element_at(F.col("_ring"), (F.pmod(i + 1, size) + 1).cast("int"))
        ex, ey = n["x"] - v["x"], n["y"] - v["y"]
        # signed distance to the edge line, positive outside
        gap = (ey * (F.col("x") - v["x"]) - ex * (F.col("y") - v["y"])) / F.sqrt(ex * ex + ey * ey)
        return F.when(gap > tolerance, 1).otherwise(0)

    bad = F.aggregate(F.transform("_ring", outside), F.lit(0), lambda a, b: a + b)
    return joined.filter(bad == 0).select(*rows.columns)


def plot_area(plots: DataFrame, dtm: DataFrame) -> DataFrame:
    """Hectares: circle area when a radius is set, else hull area of the terrain grid."""
    area = hull_area(convex_hull(dtm.select("plot_id", *XY)))
    circle = half_even(F.pi() * F.col("plot_radius") * F.col("plot_radius") / 10000.0, 3)
    out = plots.join(area, "plot_id", "left")
    return out.select(*plots.columns, F.when(F.col("plot_radius") > 0, circle).otherwise(F.col("hull_area") / 10000.0).alias("area_ha"))


# ---------------------------------------------------------------- cover and slope
def node_counts(nodes: DataFrame, points: DataFrame, radius: float, classes: dict[str, Column]) -> DataFrame:
    """Points per node in a p=10 Minkowski ball, one count per named condition."""
    pairs = radius_pairs(points, nodes.select("plot_id", "node_id", *XY), radius, XY, metric="minkowski10")
    counts = pairs.groupBy("plot_id", F.col("near.node_id").alias("node_id")).agg(
        *[F.count(F.when(cond, 1)).alias(name) for name, cond in classes.items()]
    )
    out = nodes.select("plot_id", "node_id").join(counts, ["plot_id", "node_id"], "left")
    return out.select("plot_id", "node_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in classes])


def vegetation_coverage(
    points: DataFrame, dtm: DataFrame, resolution: float = 0.2, min_hits: int = 5, veg_cutoff: float = 0.8, stem_cutoff: float = 0.4
) -> DataFrame:
    """Share of ground nodes inside the terrain hull covered by canopy, understory and CWD."""
    from arborframe.operators.clean import CWD, STEM, TERRAIN, VEGETATION

    label, h = F.col("label"), F.col("hag")
    canopy = (label == VEGETATION) & (h > veg_cutoff)
    low = ((label == VEGETATION) & (h <= veg_cutoff)) | ((label == STEM) & (h <= stem_cutoff))
    nodes = grid_nodes(points.filter(label == TERRAIN), resolution, margin=0.0)
    nodes = inside_hull(nodes, convex_hull(dtm.select("plot_id", *XY)))
    used = points.filter(canopy | low | (label == CWD)).select("plot_id", *XY, "label", "hag")
    counts = node_counts(nodes, used, resolution, {"canopy": canopy, "understory": low, "cwd": label == CWD})
    return counts.groupBy("plot_id").agg(
        F.count(F.lit(1)).alias("n_nodes"),
        *[F.avg((F.col(c) > min_hits).cast("double")).alias(f"{c}_fraction") for c in ("canopy", "understory", "cwd")],
    )


def plot_gradient(dtm: DataFrame) -> DataFrame:
    """Slope of the best-fit plane (total least squares) of each plot's terrain grid.

    Moment sums per plot, then the smallest eigenvector of the 3x3 covariance in
    closed form, so no point leaves the executors.
    """
    sums = dtm.groupBy("plot_id").agg(
        *[F.avg(c).alias(f"m_{c}") for c in "xyz"],
        *[F.covar_pop(a, b).alias(f"{a}{b}") for a, b in geo.MOMENTS],
    )
    base = geo.with_axis(sums, "smallest")
    n = [F.col(c) for c in ("nx", "ny", "nz")]
    one = F.lit(1.0)
    return base.select(
        "plot_id",
        geo.compute_angle(n, [F.lit(0.0), F.lit(0.0), one]).alias("avg_gradient"),
        geo.compute_angle([n[0], n[2]], [F.lit(0.0), one]).alias("avg_gradient_x"),
        geo.compute_angle([n[1], n[2]], [F.lit(0.0), one]).alias("avg_gradient_y"),
    )
