"""Cleaning, cropping, relabelling queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from arborframe.functions.numeric import half_even
from arborframe.operators import clean as cl
from arborframe.plans.registry import query
from arborframe.plans.sqltext import even, fx, normal_sql

P = fx("fx_points")
PP = fx("fx_points", "fx_plots")
IDS = ("plot_id", "point_id")
DIST = "sqrt((p.x - cx) * (p.x - cx) + (p.y - cy) * (p.y - cy))"
BOX = "SELECT plot_id, " + ", ".join(f"min({c}) AS min_{c}, max({c}) AS max_{c}" for c in "xyz") + " FROM fx_points GROUP BY plot_id"
CENTRE = f"SELECT plot_id, {even('(min(x) + max(x)) / 2', 3)} AS cx, {even('(min(y) + max(y)) / 2', 3)} AS cy, {even('min(z)', 3)} AS z0 FROM fx_points GROUP BY plot_id"


@query("F1_plot_centre", P + CENTRE)
def _(v):
    return cl.plot_centre(v.points)


@query("F2_crop_circle", PP + f"SELECT p.plot_id, point_id FROM fx_points p JOIN fx_plots USING (plot_id) WHERE plot_radius = 0 OR {DIST} < plot_radius + plot_radius_buffer")
def _(v):
    return cl.crop_circle(v.points, v.plots).select(*IDS)


@query("F3_crop_circle_dtm", fx("fx_dtm", "fx_plots") + f"SELECT p.plot_id, gx, gy, {DIST} < plot_radius AS in_final FROM fx_dtm p JOIN fx_plots USING (plot_id) WHERE plot_radius = 0 OR {DIST} <= plot_radius + plot_radius_buffer")
def _(v):
    crop = cl.crop_circle(v.dtm, v.plots, with_buffer=True, inclusive=True)
    final = cl.crop_circle(v.dtm, v.plots, with_buffer=False).select("plot_id", "gx", "gy", F.lit(True).alias("in_final"))
    return crop.join(final, ["plot_id", "gx", "gy"], "left").select("plot_id", "gx", "gy", F.coalesce("in_final", F.lit(False)).alias("in_final"))


@query("F4_drop_noise_class", P + "SELECT plot_id, point_id FROM fx_points WHERE classification <> 7")
def _(v):
    return cl.drop_noise_class(v.points).select(*IDS)


RETURNS = """SELECT p.plot_id, point_id FROM fx_points p JOIN (SELECT plot_id, min(return_number{s}) AS lo, max(return_number{s}) AS hi, max(z) AS top FROM fx_points GROUP BY plot_id) a USING (plot_id)
WHERE CASE WHEN lo = 0 THEN return_number{s} <= 0 WHEN hi > 1 THEN NOT (return_number{s} < 2 AND z < top - 5) ELSE TRUE END"""


@query("F5_filter_returns_mobile", P + RETURNS.format(s=""))
def _(v):
    return cl.filter_returns(v.points).select(*IDS)


@query("F5_filter_returns_airborne", P + RETURNS.format(s=" + 1"))
def _(v):
    return cl.filter_returns(v.points.withColumn("return_number", F.col("return_number") + 1)).select(*IDS)


@query("F6_split_low_intensity", P + "SELECT plot_id, point_id, intensity >= 10 AS kept FROM fx_points")
def _(v):
    kept, low = cl.split_low_intensity(v.points, 10)
    return kept.select(*IDS, F.lit(True).alias("kept")).union(low.select(*IDS, F.lit(False).alias("kept")))


@query("F6_low_intensity_vegetation", P + "SELECT plot_id, point_id, 2 AS label FROM fx_points WHERE intensity < 10 AND hag > 4.0")
def _(v):
    return cl.low_intensity_vegetation(cl.split_low_intensity(v.points, 10)[1], 4.0, 2.8).select(*IDS, "label")


@query("F7_filter_far_range", P + "SELECT p.plot_id, point_id FROM fx_points p JOIN (SELECT plot_id, min(z) AS low FROM fx_points GROUP BY plot_id) a USING (plot_id) WHERE NOT (scan_range > 12 AND z < low + 12)")
def _(v):
    return cl.filter_far_range(v.points, "scan_range", 12.0, 12.0).select(*IDS)


@query("F8_dedup_xyz", P + "SELECT plot_id, min(point_id) AS point_id FROM fx_points GROUP BY plot_id, " + ", ".join(even(c, 3) for c in "xyz"))
def _(v):
    return cl.dedup_xyz(v.points).select(*IDS)


GAP = "sqrt((p.x - q.x) * (p.x - q.x) + (p.y - q.y) * (p.y - q.y) + (p.z - q.z) * (p.z - q.z))"
CLOSE = f"p.plot_id = q.plot_id AND p.point_id <> q.point_id AND abs(p.x - q.x) < 0.3 AND abs(p.y - q.y) < 0.3 AND abs(p.z - q.z) < 0.3 AND {GAP} < 0.3"
SPOTS = "(SELECT plot_id, min(point_id) AS point_id, any_value(x) AS x, any_value(y) AS y, any_value(z) AS z FROM fx_points GROUP BY plot_id, " + ", ".join(even(c, 3) for c in "xyz") + ")"
THIN = fx("fx_points").rstrip().replace("WITH ", "WITH RECURSIVE ", 1) + f""", rec(rnd, plot_id, point_id, x, y, z) AS (
  SELECT 0, plot_id, point_id, x, y, z FROM {SPOTS}
  UNION ALL
  SELECT rnd + 1, plot_id, point_id, x, y, z FROM (SELECT p.*, q.z AS qz, row_number() OVER (PARTITION BY p.point_id ORDER BY {GAP}, q.point_id) AS r FROM rec p JOIN rec q ON {CLOSE}) WHERE r = 1 AND z < qz),
cnt AS (SELECT rnd, plot_id, count(*) AS n FROM rec GROUP BY rnd, plot_id)
SELECT a.plot_id, a.point_id FROM rec a JOIN cnt ON a.rnd = cnt.rnd AND a.plot_id = cnt.plot_id AND (a.rnd = 0 OR n > 1)
ANTI JOIN (SELECT p.rnd, p.point_id FROM rec p JOIN rec q ON p.rnd = q.rnd AND {CLOSE}) c ON c.rnd = a.rnd AND c.point_id = a.point_id"""


@query("F9_thin_min_spacing", THIN)
def _(v):
    return cl.thin_min_spacing(cl.dedup_xyz(v.points), 0.3).select(*IDS)


@query("F10_shift_origin", PP + f"SELECT p.plot_id, point_id, {even('x - cx', 6)} AS x, {even('y - cy', 6)} AS y FROM fx_points p JOIN ({CENTRE}) USING (plot_id)")
def _(v):
    out = cl.shift_origin(v.points, cl.plot_centre(v.points))
    return out.select(*IDS, half_even(F.col("x"), 6).alias("x"), half_even(F.col("y"), 6).alias("y"))


@query("F11_label_shift", P + "SELECT plot_id, point_id, CAST(label + 1 AS INT) AS label FROM fx_points")
def _(v):
    return cl.label_shift(v.points, 1).select(*IDS, "label")


@query("F12_below_ground_filter", P + "SELECT plot_id, point_id FROM fx_points WHERE hag > -0.2")
def _(v):
    return cl.below_ground_filter(v.points).select(*IDS)


@query("F13_relabel_ground", P + "SELECT plot_id, point_id, CAST(CASE WHEN abs(hag) < 0.2 THEN 1 ELSE label END AS INT) AS label FROM fx_points")
def _(v):
    return cl.relabel_ground(v.points).select(*IDS, "label")


@query("F14_height_class", P + "SELECT plot_id, point_id, CAST(CASE WHEN hag <= 0.1 THEN 2 WHEN hag <= 0.3 THEN 3 WHEN hag <= 2 THEN 4 ELSE 5 END AS INT) AS height_class FROM fx_points")
def _(v):
    return cl.height_class(v.points).select(*IDS, "height_class")


@query("F15_split_ground_veg", P + """SELECT plot_id, point_id, CAST(CASE WHEN label = 2 AND hag <= 0.8 THEN 6 ELSE label END AS INT) AS label,
  (label = 2 AND hag <= 0.8) OR (label = 4 AND hag <= 0.4) AS ground FROM fx_points WHERE label IN (2, 4)""")
def _(v):
    tall, ground = cl.split_ground_veg(v.points, 0.8, 0.4)
    cols = [*IDS, "label"]
    return tall.select(*cols, F.lit(False).alias("ground")).union(ground.select(*cols, F.lit(True).alias("ground")))


@query("F16_class_split_counts", P + """SELECT plot_id, count(*) FILTER (label = 1) AS n_terrain, count(*) FILTER (label = 2) AS n_vegetation,
  count(*) FILTER (label = 3) AS n_cwd, count(*) FILTER (label = 4) AS n_stem FROM fx_points GROUP BY plot_id""")
def _(v):
    return cl.class_counts(v.points)


@query("F17_cylinder_gate", fx("fx_cylinders") + "SELECT plot_id, cyl_id FROM fx_cylinders WHERE (cci >= 40 OR cci = 0) AND radius * 2 < 0.5 AND radius * 2 > 0.04")
def _(v):
    return cl.cylinder_gate(v.cylinders, 40, 0.5).select("plot_id", "cyl_id")


@query("F18_height_normalise", P + f"SELECT plot_id, point_id, {even('hag', 3)} AS z FROM fx_points WHERE {even('hag', 3)} >= 0")
def _(v):
    return cl.height_normalise(v.points).select(*IDS, "z")


@query("F19_dbh_slice", PP + f"SELECT p.plot_id, point_id, label FROM fx_points p JOIN fx_plots USING (plot_id) WHERE abs(hag - 1.4) < 0.03 AND {DIST} < plot_radius")
def _(v):
    return cl.dbh_slice(v.points, v.plots, 1.4).select(*IDS, "label")


@query("F21_field_filter", fx("fx_field_trees") + "SELECT plot_id, tree_id, dbh_mm, coalesce(field_id, 0) AS tree_number FROM fx_field_trees WHERE NOT (coalesce(dbh_mm < 110, FALSE) AND field_id IS NULL)")
def _(v):
    return cl.field_filter(v.field_trees).select("plot_id", "tree_id", "dbh_mm", "tree_number")


TREE_ID = "CASE WHEN label IN (2, 4) THEN CASE WHEN intensity % 7 = 0 THEN -1 ELSE intensity END END"


@query("F22_final_cloud", PP + f"""SELECT p.plot_id, point_id, tree_id, {even('x', 3)} AS x, {even('y', 3)} AS y, {even('z', 3)} AS z
FROM (SELECT *, CAST(coalesce({TREE_ID}, 0) AS INT) AS tree_id, label IN (2, 4) AS assigned FROM fx_points) p JOIN fx_plots USING (plot_id)
WHERE (assigned AND tree_id >= 0) OR {DIST} < plot_radius""")
def _(v):
    pts = v.points.withColumn("tree_id", F.expr(f"CAST(coalesce({TREE_ID}, 0) AS INT)"))
    assigned, rest = pts.filter("label IN (2, 4)"), pts.filter("label NOT IN (2, 4)")
    return cl.final_cloud(assigned, rest, v.plots).select(*IDS, "tree_id", "x", "y", "z")


@query("F23_drop_z_band", P + "SELECT plot_id, point_id FROM fx_points WHERE NOT (z >= 5 AND z <= 8)")
def _(v):
    return cl.z_band(v.points, 5.0, 8.0).select(*IDS)


@query("F23_keep_z_band", P + "SELECT plot_id, point_id FROM fx_points WHERE z >= 5 AND z <= 8")
def _(v):
    return cl.z_band(v.points, 5.0, 8.0, keep="inside").select(*IDS)


def _jitter(axis: str, shift: int) -> str:
    return even(f"CASE WHEN copy = 0 THEN {axis} ELSE {axis} - 0.025 + 0.025 * {normal_sql('(point_id * 31 + copy)', 1 + shift)} END", 6)


@query("F24_jitter_copies", P + f"SELECT plot_id, point_id, copy, {_jitter('x', 0)} AS x, {_jitter('y', 101)} AS y, {_jitter('z', 202)} AS z FROM fx_points, (SELECT CAST(unnest(range(0, 3)) AS INT) AS copy)")
def _(v):
    out = cl.jitter_copies(v.points, 2)
    return out.select(*IDS, "copy", *[half_even(F.col(c), 6).alias(c) for c in "xyz"])


@query("F24_jitter_densify")
def _(v):
    return cl.jitter_densify(v.points.select(*IDS, *"xyz"), 1, 0.05).select(*IDS, *[half_even(F.col(c), 6).alias(c) for c in "xyz"])


@query("A33_bbox", P + "SELECT plot_id, min(x) AS xmin, max(x) AS xmax, min(y) AS ymin, max(y) AS ymax, min(z) AS zmin, max(z) AS zmax, min(intensity) AS intensitymin, max(intensity) AS intensitymax FROM fx_points GROUP BY plot_id")
def _(v):
    return cl.bbox(v.points, ["x", "y", "z", "intensity"])


@query("A34_gps_summary", P + f"SELECT plot_id, {even('avg(gps_time)', 4)} AS mean_gps_time, min(gps_time) AS scan_start FROM fx_points GROUP BY plot_id")
def _(v):
    return cl.gps_summary(v.points).withColumn("mean_gps_time", half_even(F.col("mean_gps_time"), 4))
