"""Sources, parameters, straightness, training selection, field data and report tables."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from arborframe import params as pa
from arborframe.functions.numeric import half_even
from arborframe.lineage import cut_lineage, scratch_path
from arborframe.operators import field as fi
from arborframe.operators import report as rp
from arborframe.operators import straightness as st
from arborframe.operators import training as tr
from arborframe.plans.queries_measure import PLOT_STATS, TREES, plot_frame, stats_frame, tree_frame
from arborframe.plans.registry import query
from arborframe.plans.sqltext import even, fx
from arborframe.sources import points as so

P = fx("fx_points")


# ---------------------------------------------------------------- sources and sinks
@query("S1_load_points", P + "SELECT x, y, z, intensity FROM fx_points")
def _(v):
    return so.select_dims(v.points, ["x", "y", "z", "intensity", "Ring", "Range"])


@query("S1_load_points_with_ids", P + "SELECT plot_id, count(*) AS n, count(*) AS n_ids, count(*) AS n_again, min(x) AS x_min, max(z) AS z_max FROM fx_points GROUP BY plot_id")
def _(v):
    # two readings of the written cloud agree point by point, also when the files are split elsewhere
    path = scratch_path(v.spark)
    so.write_by(v.points.select("plot_id", "x", "y", "z", "intensity"), path, "plot_id", rows_per_file=20_000)
    headers = ["plot_id", "x", "y", "z", "intensity"]
    cloud = so.load_points(v.spark, path, headers, ids=True)
    again = so.load_points(v.spark, path, headers, ids=True).select("point_id", *[F.col(c).alias(f"{c}_2") for c in headers])
    same = F.count_if((F.col("x") == F.col("x_2")) & (F.col("y") == F.col("y_2")) & (F.col("z") == F.col("z_2")) & (F.col("plot_id") == F.col("plot_id_2")))
    facts = [F.count(F.lit(1)).alias("n"), F.count_distinct("point_id").alias("n_ids"), same.alias("n_again"), F.min("x").alias("x_min"), F.max("z").alias("z_max")]
    return cloud.join(again, "point_id").withColumn("plot_id", F.col("plot_id").cast("int")).groupBy("plot_id").agg(*facts)


@query("S2_save_points", P + "SELECT plot_id, point_id, x, y, z, intensity FROM fx_points")
def _(v):
    path = scratch_path(v.spark)
    cloud = v.points.select("plot_id", "point_id", "x", "y", "z", "intensity")
    so.save_points(cloud.withColumn("ring", F.lit(0)), path)
    return so.read_by(cloud, path)


@query("S2_drop_empty_attributes", P + "SELECT plot_id, point_id, x, y, z, intensity FROM fx_points")
def _(v):
    cloud = v.points.select("plot_id", "point_id", "x", "y", "z", "intensity").withColumn("ring", F.lit(0))
    return so.drop_empty_attributes(cloud)


@query("S3_coords_quantise", P + f"SELECT point_id, {', '.join(f'CAST(' + even(f'({c} - {o}) / 0.001') + f' AS BIGINT) AS {c}_q' for c, o in (('x', -20.0), ('y', -20.0), ('z', 0.0)))} FROM fx_points")
def _(v):
    return so.coords_quantise(v.points, (-20.0, -20.0, 0.0)).select("point_id", "x_q", "y_q", "z_q")


@query("S4_typed_dims", P + "SELECT point_id, x, CAST(intensity AS INT) AS intensity, CAST(label AS SMALLINT) AS label, CAST(scan_range AS FLOAT) AS range, CAST(hag AS FLOAT) AS hag FROM fx_points")
def _(v):
    return so.typed_dims(v.points.select("point_id", "x", "intensity", "label", F.col("scan_range").alias("range"), "hag"))


NAMES = "names AS (SELECT s_suppkey, concat('c:\\scans/plot', s_suppkey, '_scan.v', s_suppkey % 3, CASE WHEN s_suppkey % 4 = 0 THEN '.las' ELSE '.laz' END) AS p1, concat('d/x', s_suppkey, CASE WHEN s_suppkey % 5 = 0 THEN '_FT_output/a' ELSE '' END, '.laz') AS p2 FROM supplier)"


def names(v):
    s = v.spark.read.parquet(f"{v.sf_dir}/supplier.parquet")
    k = F.col("s_suppkey")
    ext = F.when(k % 4 == 0, ".las").otherwise(".laz")
    return s.select(
        "s_suppkey",
        F.concat(F.lit("c:\\scans/plot"), k, F.lit("_scan.v"), k % 3, ext).alias("p1"),
        F.concat(F.lit("d/x"), k, F.when(k % 5 == 0, "_FT_output/a").otherwise(""), F.lit(".laz")).alias("p2"),
    )


@query("S5_plot_id_from_name", f"WITH {NAMES} SELECT s_suppkey, concat('plot', s_suppkey) AS id1, concat('x', s_suppkey) AS id2 FROM (SELECT s_suppkey FROM names WHERE s_suppkey % 5 <> 0) UNION ALL SELECT s_suppkey, concat('plot', s_suppkey), 'a' FROM names WHERE s_suppkey % 5 = 0")
def _(v):
    return names(v).select("s_suppkey", so.plot_id_from_name(F.col("p1")).alias("id1"), so.plot_id_from_name(F.col("p2")).alias("id2"))


@query("S6_discover_inputs", f"WITH {NAMES} SELECT s_suppkey FROM names WHERE p1 LIKE '%.laz' AND p2 NOT LIKE '%FT_output%'")
def _(v):
    return so.discover_inputs(so.discover_inputs(names(v), "p1"), "p2").select("s_suppkey")


@query("S6_list_inputs", P + "SELECT plot_id, count(*) AS n FROM fx_points GROUP BY plot_id")
def _(v):
    # every plot's clouds are written, found by listing the folder, and counted
    path = scratch_path(v.spark)
    so.write_by(v.points.select("plot_id", "x", "y", "z"), path, "plot_id")
    listed = so.list_inputs(v.spark, path, ".parquet").select(F.regexp_extract("path", r"plot_id=(\d+)/", 1).cast("long").alias("plot_id")).distinct()
    stored = so.read_by(v.points.select("plot_id", "x", "y", "z"), path).groupBy("plot_id").agg(F.count(F.lit(1)).alias("n"))
    return stored.join(listed, "plot_id", "left_semi")


@query("S7_combine_plots", fx("fx_taper", "fx_field_trees") + "SELECT plot_id, tree_id, height, NULL::DOUBLE AS bearing, cci FROM fx_taper UNION ALL SELECT plot_id, tree_id, height, bearing, NULL FROM fx_field_trees")
def _(v):
    return so.combine_plots([v.taper.select("plot_id", "tree_id", "height", "cci"), v.field_trees.select("plot_id", "tree_id", "height", "bearing")])


@query("S8_drop_label", P + "SELECT point_id, x, y, z FROM (SELECT *, CASE classification WHEN 7 THEN 'p_segmented_raw.laz' ELSE 'p_C2.laz' END AS source FROM fx_points) WHERE source NOT LIKE '%segmented_raw%' AND source NOT LIKE '%terrain_points%'")
def _(v):
    cloud = v.points.withColumn("source", F.when(F.col("classification") == 7, "p_segmented_raw.laz").otherwise("p_C2.laz"))
    return so.drop_label(cloud.select("point_id", "x", "y", "z", "label", "source"), "source").drop("source")


@query("S9_unlabelled_test_copy", P + "SELECT point_id, 'test' AS split FROM fx_points WHERE intensity < 25")
def _(v):
    split = v.points.select("point_id", "label", F.when(F.col("intensity") < 25, "test").otherwise("train").alias("split"))
    return so.unlabelled_test_copy(split)


@query("S10_merge_clouds", fx("fx_points", "fx_dtm").rstrip() + f""", g AS (SELECT plot_id, avg(gps_time) AS gps FROM fx_points GROUP BY plot_id), merged AS (
SELECT plot_id, x, y, z, classification, label, gps_time, 0 AS tree_id FROM fx_points
UNION ALL SELECT plot_id, x, y, z, CASE WHEN intensity % 3 = 0 THEN 1 ELSE intensity % 3 END, label, gps, intensity FROM fx_points JOIN g USING (plot_id) WHERE label IN (2, 4)
UNION ALL SELECT plot_id, x, y, z, 8, 0, gps, 0 FROM fx_dtm JOIN g USING (plot_id))
SELECT plot_id, x, y, z, CAST(classification AS INT) AS classification, CAST(label AS INT) AS label, {even('gps_time', 4)} AS gps_time, CAST(tree_id AS BIGINT) AS tree_id FROM merged""")
def _(v):
    cols = ["plot_id", "x", "y", "z", "classification", "label", "gps_time"]
    trees = v.points.filter("label IN (2, 4)").withColumns({"classification": F.col("intensity") % 3, "tree_id": F.col("intensity").cast("long")})
    out = so.merge_clouds(v.points.select(*cols), trees.select(*cols, "tree_id"), v.dtm.select("plot_id", "x", "y", "z"))
    return out.select("plot_id", "x", "y", "z", "classification", "label", half_even(F.col("gps_time"), 4).alias("gps_time"), "tree_id")


BY_TREE = fx("fx_points", "fx_cylinders").rstrip() + """, sk AS (SELECT DISTINCT plot_id, tree_id, x, y FROM fx_cylinders)
SELECT plot_id, CAST(intensity % 50 AS BIGINT) AS tree_id, point_id, label FROM fx_points WHERE label IN (2, 4)
UNION ALL SELECT DISTINCT p.plot_id, sk.tree_id, p.point_id, p.label FROM fx_points p JOIN sk ON p.plot_id = sk.plot_id AND p.label = 1 AND abs(p.x - sk.x) <= 2.5 AND abs(p.y - sk.y) <= 2.5
  AND sqrt((p.x - sk.x) * (p.x - sk.x) + (p.y - sk.y) * (p.y - sk.y)) <= 2.5"""


def by_tree(v):
    cols = ["plot_id", "tree_id", "point_id", "label", "x", "y", "z"]
    trees = v.points.filter("label IN (2, 4)").withColumn("tree_id", (F.col("intensity") % 50).cast("long")).select(*cols)
    out = so.split_by_tree(trees, v.points.filter("label = 1").select("plot_id", "point_id", "label", "x", "y", "z"), v.cylinders, 2.5)
    return out.select("plot_id", "tree_id", "point_id", "label")


@query("S11_split_by_tree", BY_TREE)
def _(v):
    return by_tree(v)


@query("S11_split_by_tree_sink", BY_TREE)
def _(v):
    path, rows = scratch_path(v.spark), cut_lineage(by_tree(v))
    so.write_by(rows, path, "plot_id", "tree_id")
    return so.read_by(rows, path)


SETTINGS = """client AS (SELECT s_suppkey AS plot_id, 'dbh_height' AS name, 1.3::DOUBLE AS value FROM supplier UNION ALL SELECT s_suppkey, 'plot_radius', s_suppkey::DOUBLE FROM supplier),
base AS (SELECT s_suppkey AS plot_id, 'plot_radius' AS name, 14.1::DOUBLE AS value FROM supplier WHERE s_suppkey % 2 = 0),
scan AS (SELECT s_suppkey AS plot_id, 'gap_connect' AS name, 0.5::DOUBLE AS value FROM supplier UNION ALL SELECT s_suppkey, 'plot_radius', 0 FROM supplier WHERE s_suppkey % 6 = 0)"""


@query("S13_plot_params", f"WITH {SETTINGS} SELECT plot_id, name, coalesce(s.value, b.value, c.value) AS value FROM client c FULL JOIN base b USING (plot_id, name) FULL JOIN scan s USING (plot_id, name)")
def _(v):
    s = v.spark.read.parquet(f"{v.sf_dir}/supplier.parquet").select(F.col("s_suppkey").alias("plot_id"))

    def row(df, name, value):
        return df.select("plot_id", F.lit(name).alias("name"), value.cast("double").alias("value"))

    k = F.col("plot_id")
    client = row(s, "dbh_height", F.lit(1.3)).union(row(s, "plot_radius", k))
    base = row(s.filter(k % 2 == 0), "plot_radius", F.lit(14.1))
    scan = row(s, "gap_connect", F.lit(0.5)).union(row(s.filter(k % 6 == 0), "plot_radius", F.lit(0)))
    return pa.plot_params(client, base, scan)


@query("S14_params_from_survey", fx("fx_survey") + f"SELECT plot_id, {even('mindbh / 1000 - 0.02::DOUBLE', 2)} AS minimum_dbh, {even('maxdbh / 1000 * 5 / 4', 2)} AS maximum_dbh, {even('tree_height / 3', 2)} AS tree_stem_min_height, ground_veg_cutoff_height FROM fx_survey")
def _(v):
    return pa.params_from_survey(v.survey)


@query("S15_plot_list_params", fx("fx_points", "fx_plots") + "SELECT point_id, cx, cy, plot_radius FROM fx_points JOIN fx_plots USING (plot_id)")
def _(v):
    return pa.with_plot_list(v.points, v.plots).select("point_id", "cx", "cy", "plot_radius")


@query("S16_strip_headers", fx("fx_diameters") + "SELECT row_id, tree_height FROM fx_diameters")
def _(v):
    return so.strip_headers(v.diameters.select(F.col("row_id").alias(" row_id\t"), F.col("tree_height").alias("tree_height ")))


@query("S17_has_label", P + "SELECT plot_id, count(label) > 0 AS has_label FROM (SELECT plot_id, CASE WHEN plot_id = 2 THEN NULL ELSE label END AS label FROM fx_points) GROUP BY plot_id")
def _(v):
    return so.has_label(v.points.withColumn("label", F.when(F.col("plot_id") != 2, F.col("label"))))


# ---------------------------------------------------------------- straightness
KEYS = fx("fx_taper").rstrip() + """, rel AS (SELECT *, bin_x - first_value(bin_x) OVER w AS x, bin_y - first_value(bin_y) OVER w AS y FROM fx_taper WINDOW w AS (PARTITION BY plot_id, tree_id ORDER BY height_bin)),
d AS (SELECT *, sqrt(x * x + y * y) AS dist, ma_diameter / 2 AS r FROM rel),
rk AS (SELECT *, row_number() OVER (PARTITION BY plot_id, tree_id ORDER BY height_bin) AS lo, row_number() OVER (PARTITION BY plot_id, tree_id ORDER BY height_bin DESC) AS hi,
  row_number() OVER (PARTITION BY plot_id, tree_id ORDER BY dist DESC, height_bin) AS fa FROM d)"""


@query("W10_furthest_cylinder", KEYS + f""" SELECT plot_id, tree_id, kind, height_bin, {even('x', 6)} AS x, {even('y', 6)} AS y, {even('dist', 6)} AS dist, r FROM (
SELECT *, 'bottom' AS kind FROM rk WHERE lo = 1 UNION ALL SELECT *, 'top' FROM rk WHERE hi = 1 UNION ALL SELECT *, 'furthest' FROM rk WHERE fa = 1)""")
def _(v):
    out = st.furthest_cylinder(v.taper)
    return out.select("plot_id", "tree_id", "kind", "height_bin", *[half_even(F.col(c), 6).alias(c) for c in ("x", "y", "dist")], "r")


STRAIGHT = KEYS + """, w AS (SELECT b.plot_id, b.tree_id, b.x AS bx, b.y AS by, b.r AS br, b.height_bin AS bz, t.x AS tx, t.y AS ty, t.r AS tr, t.height_bin AS tz, t.dist >= m.dist AS same,
  m.x AS mx, m.y AS my, m.r AS mr, m.height_bin AS mz FROM rk b JOIN rk t USING (plot_id, tree_id) JOIN rk m USING (plot_id, tree_id) WHERE b.lo = 1 AND t.hi = 1 AND m.fa = 1),
f AS (SELECT *, CASE WHEN same THEN tx ELSE mx END AS fx, CASE WHEN same THEN ty ELSE my END AS fy, CASE WHEN same THEN tr ELSE mr END AS fr FROM w),
c AS (SELECT *, CASE WHEN h > 0 THEN abs(fx - bx) / h END AS c, (abs(bx) + 0.3 * 2 * br < abs(tx) AND abs(by) + 0.3 * 2 * br < abs(ty)) AND NOT (abs(fx) + 0.1 * 2 * fr < abs(tx) AND abs(fy) + 0.1 * 2 * fr < abs(ty)) AS branch,
  CASE WHEN tx < 0 THEN -1 ELSE 1 END AS sx, CASE WHEN ty < 0 THEN -1 ELSE 1 END AS sy FROM (SELECT *, sqrt((fx - bx) * (fx - bx) + (fy - by) * (fy - by)) AS h FROM f)),
e AS (SELECT *, """ + ", ".join(
    f"{s}x + sx * c * {s}r AS {s}ex, {s}y + sy * sqrt(greatest({s}r * {s}r - c * {s}r * (c * {s}r), 0)) AS {s}ey" for s in "btm"
) + """ FROM c),
g AS (SELECT * REPLACE (CASE WHEN same THEN tex ELSE mex END AS mex, CASE WHEN same THEN tey ELSE mey END AS mey), CASE WHEN tz = mz THEN tz / 10000 ELSE tz - mz END AS hh,
  sqrt((tex - bex) * (tex - bex) + (tey - bey) * (tey - bey) + (tz - bz) * (tz - bz)) AS dd, sqrt((tex - bex) * (tex - bex) + (tey - bey) * (tey - bey)) AS ee FROM e),
ph AS (SELECT *, acos(least(greatest(sqrt(greatest(dd * dd - ee * ee, 0)) / dd, -1), 1)) AS phi, (mz - tz) / (bz - tz) AS t FROM g WHERE tz <> bz),
l AS (SELECT *, sqrt(greatest((hh / cos(phi)) * (hh / cos(phi)) - hh * hh, 0)) AS len, tex + t * (bex - tex) AS px, tey + t * (bey - tey) AS py FROM ph),
q AS (SELECT *, sqrt((mex - px) * (mex - px) + (mey - py) * (mey - py)) AS nn FROM l),
s AS (SELECT *, CASE WHEN nn < 1e-10 THEN px ELSE px + len * (mex - px) / nn END AS qx, CASE WHEN nn < 1e-10 THEN py ELSE py + len * (mey - py) / nn END AS qy FROM q),
ra AS (SELECT plot_id, tree_id, CASE WHEN NOT branch AND c IS NOT NULL THEN sqrt((qx - mex) * (qx - mex) + (qy - mey) * (qy - mey)) / (2 * tr) END AS ratio FROM s),
res AS (SELECT w.plot_id, w.tree_id, w.tz AS top_height, ratio FROM w LEFT JOIN ra USING (plot_id, tree_id))"""
STRAIGHT = re.sub(r"\bby\b", "b_y", STRAIGHT)
CLASS_SQL = """CASE WHEN ratio IS NULL THEN 'no score' WHEN ratio >= 0.5 THEN '1' WHEN top_height > 6 THEN CASE WHEN ratio < 1 / 8.0::DOUBLE THEN '8' WHEN ratio < 1 / 6.0::DOUBLE THEN '6' WHEN ratio < 1 / 5.0::DOUBLE THEN 'L' ELSE 'exception' END
WHEN top_height > 4 THEN CASE WHEN ratio < 1 / 5.0::DOUBLE THEN 'S' WHEN ratio < 1 / 3.0::DOUBLE THEN '3' END ELSE 'regen' END"""


@query("K7_straightness", STRAIGHT + f" SELECT plot_id, tree_id, {even('ratio', 5)} AS ratio, top_height, {CLASS_SQL} AS straightness FROM res")
def _(v):
    return st.straightness(v.taper).withColumn("ratio", half_even(F.col("ratio"), 5))


# ---------------------------------------------------------------- training selection
@query("A25_stem_share", P + f"SELECT plot_id, {even('avg(CASE WHEN label = 4 THEN 1.0 ELSE 0.0 END)', 9)} AS stem_share FROM fx_points GROUP BY plot_id")
def _(v):
    return tr.stem_share(v.points).withColumn("stem_share", half_even(F.col("stem_share"), 9))


Q = "quantile_cont(z, 0.25) AS q1, quantile_cont(z, 0.5) AS q2, quantile_cont(z, 0.75) AS q3"
FENCE = f"fence AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper FROM (SELECT plot_id, {Q} FROM fx_points GROUP BY plot_id))"


@query("A26_iqr_bounds", P.rstrip() + f", {FENCE} SELECT plot_id, {', '.join(even(c, 6) + ' AS ' + c for c in ('q1', 'q2', 'q3', 'lower', 'upper'))} FROM fence")
def _(v):
    out = tr.iqr_bounds(v.points, "z", ["plot_id"])
    return out.select("plot_id", *[half_even(F.col(c), 6).alias(c) for c in ("q1", "q2", "q3", "lower", "upper")])


@query("A26_outliers_iqr", fx("fx_cylinders") + "SELECT c.plot_id, cyl_id, h < lower OR h > upper AS outlier FROM (SELECT *, height_above_dtm * radius * radius AS h FROM fx_cylinders) c JOIN (SELECT plot_id, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper FROM (SELECT plot_id, quantile_cont(height_above_dtm * radius * radius, 0.25) AS q1, quantile_cont(height_above_dtm * radius * radius, 0.75) AS q3 FROM fx_cylinders GROUP BY plot_id)) f ON c.plot_id = f.plot_id")
def _(v):
    rows = v.cylinders.select("plot_id", "cyl_id", (F.col("height_above_dtm") * F.col("radius") * F.col("radius")).alias("h"))
    return tr.outliers_iqr(rows, "h", ["plot_id"]).select("plot_id", "cyl_id", "outlier")


@query("A27_select_by_stem_share", P.rstrip() + """, sh AS (SELECT intensity AS plot_id, avg(CASE WHEN label = 4 THEN 1.0 ELSE 0.0 END) AS s FROM fx_points GROUP BY intensity),
f AS (SELECT quantile_cont(s, 0.25) AS q1, quantile_cont(s, 0.5) AS q2, quantile_cont(s, 0.75) AS q3 FROM sh)
SELECT plot_id FROM sh, f WHERE s > q2 AND s < q3 + 1.5 * (q3 - q1)""")
def _(v):
    # 100 sources, one per intensity value
    shares = tr.stem_share(v.points.drop("plot_id").withColumnRenamed("intensity", "plot_id"))
    return tr.select_by_stem_share(shares).select("plot_id")


STATS = "st AS (SELECT plot_id, label, quantile_cont(z, 0.25) AS q25, quantile_cont(z, 0.5) AS q50, quantile_cont(z, 0.75) AS q75, avg(z) AS mean_z, stddev_pop(z) AS std_z, min(z) AS min_z, max(z) AS max_z FROM pts WHERE label IN (2, 4) GROUP BY plot_id, label)"
# canopy raised by 6 m so that the two classes differ
PTS = P.rstrip() + ", pts AS (SELECT plot_id, label, point_id, CASE WHEN label = 2 THEN z * 0.8 + 6 ELSE z END AS z FROM fx_points), " + STATS
WIDE = PTS + """, wd AS (SELECT s.plot_id, s.mean_z AS m1, s.std_z AS s1, s.q75 AS sq75, s.min_z AS smin, s.max_z AS smax, v.mean_z AS m2, v.std_z AS s2, v.q25 AS vq25, v.min_z AS vmin, v.max_z AS vmax
FROM st s JOIN st v ON s.plot_id = v.plot_id AND s.label = 4 AND v.label = 2)"""


def raised(v):
    return v.points.withColumn("z", F.when(F.col("label") == 2, F.col("z") * 0.8 + 6).otherwise(F.col("z")))


def height_stats(v):
    return tr.class_height_stats(raised(v))


@query("A28_class_height_stats", PTS + f" SELECT plot_id, label, {', '.join(even(c, 6) + ' AS ' + c for c in ('q25', 'q50', 'q75', 'mean_z', 'std_z', 'min_z', 'max_z'))} FROM st")
def _(v):
    out = height_stats(v)
    return out.select("plot_id", "label", *[half_even(F.col(c), 6).alias(c) for c in out.columns[2:]])


@query("A29_pdf_intersection", WIDE + f""", q AS (SELECT plot_id, m1, m2, 1 / (s1 * s1) - 1 / (s2 * s2) AS a, -2 * (m1 / (s1 * s1) - m2 / (s2 * s2)) AS b, m1 * m1 / (s1 * s1) - m2 * m2 / (s2 * s2) + 2 * ln(s1 / s2) AS c FROM wd)
SELECT plot_id, {even('CASE WHEN abs((-b + d) / (2 * a) - (m1 + m2) / 2) <= abs((-b - d) / (2 * a) - (m1 + m2) / 2) THEN (-b + d) / (2 * a) ELSE (-b - d) / (2 * a) END', 5)} AS crossing_z FROM (SELECT *, sqrt(b * b - 4 * a * c) AS d FROM q)""")
def _(v):
    return tr.pdf_intersection(height_stats(v)).withColumn("crossing_z", half_even(F.col("crossing_z"), 5))


BAND = WIDE + """, ax AS (SELECT *, least(smin, vmin) - (greatest(smax, vmax) - least(smin, vmin)) * 0.05 AS lo, greatest(smax, vmax) + (greatest(smax, vmax) - least(smin, vmin)) * 0.05 AS hi FROM wd),
gr AS (SELECT *, lo + i * (hi - lo) / 199 AS gx FROM (SELECT *, unnest(range(0, 200)) AS i FROM ax)),
ov AS (SELECT plot_id, quantile_cont(gx, 0.25) AS o25, quantile_cont(gx, 0.75) AS o75 FROM gr WHERE exp(-((gx - m1) / s1) * ((gx - m1) / s1) / 2) > 0 AND exp(-((gx - m2) / s2) * ((gx - m2) / s2) / 2) > 0 GROUP BY plot_id),
bd AS (SELECT plot_id, greatest(sq75, o25) AS band_lo, least(vq25, o75) AS band_hi FROM wd JOIN ov USING (plot_id))"""


@query("A30_ambiguous_band", BAND + f" SELECT plot_id, {even('band_lo', 6)} AS band_lo, {even('band_hi', 6)} AS band_hi FROM bd")
def _(v):
    out = tr.ambiguous_band(height_stats(v))
    return out.select("plot_id", *[half_even(F.col(c), 6).alias(c) for c in ("band_lo", "band_hi")])


WIDEN = ", bw AS (SELECT plot_id, band_lo - 8 AS band_lo, band_hi + 8 AS band_hi FROM bd)"


@query("A31_dropped_ratio", BAND + WIDEN + f" SELECT plot_id, {even('avg(CASE WHEN z >= band_lo AND z <= band_hi THEN 1.0 ELSE 0.0 END)', 9)} AS dropped_ratio FROM pts JOIN bw USING (plot_id) GROUP BY plot_id")
def _(v):
    bands = tr.ambiguous_band(height_stats(v)).withColumns({"band_lo": F.col("band_lo") - 8, "band_hi": F.col("band_hi") + 8})
    return tr.dropped_ratio(raised(v), bands).withColumn("dropped_ratio", half_even(F.col("dropped_ratio"), 9))


# ---------------------------------------------------------------- field data
H0 = "coalesce(height, 0)"


@query("K9_field_to_trees", fx("fx_field_trees") + f"""SELECT plot_id, row_number() OVER (PARTITION BY plot_id ORDER BY bearing, tree_id) AS tree_id, {even('distance * sin(radians(bearing))', 3)} AS x_tree_bh, {even('distance * cos(radians(bearing))', 3)} AS y_tree_bh, 1.4::DOUBLE AS z_tree_bh,
distance, bearing, {even('dbh_mm / 10 * 10', 3)} AS dbh, 100.0::DOUBLE AS cci_at_bh, CASE WHEN {H0} = 0 THEN {H0} + coalesce(prev_height, 0) ELSE {H0} END AS height, CAST({H0} = 0 AS INT) AS review FROM fx_field_trees""")
def _(v):
    out = fi.field_to_trees(v.field_trees.withColumn("dbh_cm", F.col("dbh_mm") / 10))
    return out.withColumn("dbh", half_even(F.col("dbh"), 3))


VR = fx("fx_vr").rstrip() + """, g AS (SELECT plot_id, CAST(floor(line_no / CAST(3 AS DOUBLE)) AS BIGINT) AS tree, max(x) FILTER (line_in_tree = 1) AS x_tree_bh, max(y) FILTER (line_in_tree = 1) AS y_tree_bh, max(position) FILTER (line_in_tree = 1) AS z_tree_bh,
max(distance) FILTER (line_in_tree = 1) AS distance, max(bearing) FILTER (line_in_tree = 1) AS bearing, max(diameter) FILTER (line_in_tree = 1) AS dbh, max(position) FILTER (line_in_tree = 2) AS height FROM fx_vr GROUP BY ALL HAVING count(*) FILTER (line_in_tree = 1) > 0)"""


@query("W9_vr_reshape", VR + " SELECT plot_id, tree, x_tree_bh, y_tree_bh, z_tree_bh, distance, bearing, dbh, height FROM g")
def _(v):
    return fi.vr_reshape(v.vr).withColumnRenamed("_tree", "tree")


@query("K10_vr_to_trees", VR + " SELECT plot_id, row_number() OVER (PARTITION BY plot_id ORDER BY bearing, tree) AS tree_id, x_tree_bh, y_tree_bh, z_tree_bh, distance, bearing, dbh, 100.0::DOUBLE AS cci_at_bh, height, 1 AS review FROM g")
def _(v):
    return fi.vr_to_trees(v.vr)


@query("S12_split_table_by_plot", VR + " SELECT plot_id, count(*) AS n_trees, min(bearing) AS first_bearing FROM g GROUP BY plot_id")
def _(v):
    # the per-plot tables are written, read back and summed up per plot
    path, rows = scratch_path(v.spark), fi.vr_to_trees(v.vr)
    so.write_by(rows, path, "plot_id")
    return so.read_by(rows, path).groupBy("plot_id").agg(F.count(F.lit(1)).alias("n_trees"), F.min("bearing").alias("first_bearing"))


@query("K11_add_dub_column", fx("fx_diameters").rstrip() + f""", r AS (SELECT * FROM fx_diameters WHERE ma_diameter IS NOT NULL AND tree_height IS NOT NULL), h AS (SELECT tree_id, arg_min(tree_height, row_id) AS h FROM r GROUP BY tree_id)
SELECT row_id, tree_id, ma_diameter, tree_height, {even('ma_diameter * sqrt(0.7016 + 0.5646 * ((h - 1.4) / h) - 0.6188 * ((h - 1.4) / h) * ((h - 1.4) / h))', 6)} AS dub FROM r JOIN h USING (tree_id)""")
def _(v):
    return fi.add_dub_column(v.diameters).withColumn("dub", half_even(F.col("dub"), 6))


FILL = fx("fx_field_trees").rstrip() + """, miss AS (SELECT *, dbh_mm IS NULL OR cci IS NULL AS missing FROM fx_field_trees),
near AS (SELECT a.plot_id, a.tree_id, abs(b.height - a.height) AS d, b.dbh_mm FROM miss a JOIN miss b ON a.plot_id = b.plot_id AND a.missing AND NOT b.missing AND a.height IS NOT NULL AND b.height IS NOT NULL),
m AS (SELECT plot_id, tree_id, (floor(min(d) / 0.1::DOUBLE) + 1) * 0.1::DOUBLE AS m FROM near GROUP BY ALL),
f AS (SELECT plot_id, tree_id, floor(median(dbh_mm)) AS fill FROM near JOIN m USING (plot_id, tree_id) WHERE d < m GROUP BY ALL)"""


@query("A32_missing_dbh_fill", FILL + " SELECT plot_id, tree_id, height, CASE WHEN missing THEN fill ELSE dbh_mm END AS dbh_mm, CASE WHEN missing THEN 0.5 ELSE cci END AS cci, CAST(missing AS INT) AS review FROM miss LEFT JOIN f USING (plot_id, tree_id)")
def _(v):
    return fi.missing_dbh_fill(v.field_trees).select("plot_id", "tree_id", "height", "dbh_mm", "cci", "review")


def qc_inputs(v):
    detected = fi.detected_tree_positions(v.cylinders, max_height=6.0, min_angle=60.0)
    qc = v.field_trees.select("plot_id", F.col("tree_id").alias("qc_id"), ((F.col("tree_id") * 7) % 40 - 20).cast("double").alias("x"), ((F.col("tree_id") * 11) % 40 - 20).cast("double").alias("y"))
    return qc, detected


@query("J14_match_qc_trees")
def _(v):
    return fi.match_qc_trees(*qc_inputs(v))[0].select("plot_id", "qc_id", "target")


@query("K12_qc_seeds")
def _(v):
    return fi.match_qc_trees(*qc_inputs(v))[1]


# ---------------------------------------------------------------- report
def full_plots(v):
    extra = {"cz": F.lit(0.5), "offset_x": F.when(F.col("plot_id") % 2 == 0, 0.0).otherwise(45000.0), "dbh_height": F.lit(1.7)}
    return plot_frame(v).withColumns(extra)


LINES = [
    ("Population Name", "plot_id", "", "", ""), ("Stratum ID", "1", "", "", ""), ("Age", "''", "", "", "years"),
    ("Plot Type", "'Circular'", "", "", ""), ("Plot Radius", "plot_radius", "", "", "metres"), ("Plot Area", "area_ha", "", "", "Ha"),
    ("Location Ref", "CASE WHEN plot_id % 2 = 0 THEN 'centre' ELSE 'world' END", "", "", ""),
    *[(f"Local {a}", f"CASE WHEN plot_id % 2 = 0 THEN CAST({c} AS VARCHAR) ELSE '' END", "", "", "metres") for a, c in (("X", "cx"), ("Y", "cy"), ("Z", "0.5::DOUBLE"))],
    *[(f"Global {a}", f"CASE WHEN plot_id % 2 = 1 THEN CAST({c} AS VARCHAR) ELSE '' END", "", "", u) for a, c, u in (("X", "cx", "metres"), ("Y", "cy", ""), ("Z", "0.5::DOUBLE", "metres"))],
    ("Trees", "n_trees", "", "", "count"), ("Stems", "n_trees", "", "", "count"), ("Stocking SPH", "stems_per_ha", "", "", "Stems per ha"),
    ("Merchantable Stems", "''", "", "", "Stems per ha"),
    ("Tree Height", "min_height", even("mean_height", 2), "max_height", "metres"), ("DBH", "min_dbh", even("mean_dbh"), "max_dbh", "millimetres"),
    ("DBH CCI", "min_cci", even("mean_cci"), "max_cci", "percent"), ("Diameter Breast Height", "1.7::DOUBLE", "", "", "metres"),
]
SUMMARY = PLOT_STATS + ", cc AS (SELECT plot_id, min(cci) AS min_cci, avg(cci) AS mean_cci, max(cci) AS max_cci FROM trees GROUP BY plot_id), al AS (SELECT * FROM stats JOIN fx_plots USING (plot_id) LEFT JOIN cc USING (plot_id)) " + " UNION ALL ".join(
    f"SELECT plot_id, {i + 1} AS line, '{a}' AS attribute, CAST({v} AS VARCHAR) AS min_value, {f'CAST({m} AS VARCHAR)' if m else chr(39) * 2} AS mean_value, {f'CAST({x} AS VARCHAR)' if x else chr(39) * 2} AS max_value, '{u}' AS units FROM al"
    for i, (a, v, m, x, u) in enumerate(LINES)
)


@query("A22_report_summary", SUMMARY)
def _(v):
    trees = tree_frame(v)
    cci = trees.groupBy("plot_id").agg(F.min("cci").alias("min_cci"), F.avg("cci").alias("mean_cci"), F.max("cci").alias("max_cci"))
    stats = stats_frame(v).drop("area_ha").join(full_plots(v), "plot_id").join(cci, "plot_id", "left")
    return rp.report_summary(stats)


@query("K6_plot_report_tables", TREES + "SELECT plot_id, tree_id AS \"Tree\", tree_x AS \"X\", tree_y AS \"Y\", distance AS \"Distance (m)\", bearing AS \"Bearing\", height AS \"Height (m)\", dbh_taper AS \"DBH (mm)\", dbh_bin AS \"DBH height (m)\", cci AS \"CCI (%)\", volume AS \"Volume (m3)\" FROM trees")
def _(v):
    return rp.report_tables(tree_frame(v).withColumn("tree_number", F.col("tree_id")), full_plots(v))[1]


def hist_sql(value: str, width: float) -> str:
    w = f"{width}::DOUBLE"
    return f""", tp AS (SELECT plot_id, ceil(ceil(max({value})) / {w}) - 1 AS n FROM trees GROUP BY plot_id)
SELECT plot_id, k * {w} AS bin_from, count(*) AS n FROM (SELECT plot_id, CASE WHEN floor({value} / {w}) = n + 1 AND {value} = (n + 1) * {w} THEN n ELSE floor({value} / {w}) END AS k FROM trees JOIN tp USING (plot_id) WHERE {value} >= {w}) GROUP BY plot_id, k"""


@query("A23_dbh_histogram", TREES + hist_sql("dbh_taper", 15.0))
def _(v):
    return rp.histogram(tree_frame(v), "dbh_taper", 15.0)


@query("A24_volume_histogram", TREES + hist_sql("volume", 0.1))
def _(v):
    return rp.histogram(tree_frame(v), "volume", 0.1)
