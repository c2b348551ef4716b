"""Terrain, height, hull, cover and slope queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from arborframe.functions.numeric import half_even
from arborframe.operators import clean as cl
from arborframe.operators import terrain as te
from arborframe.plans.registry import query
from arborframe.plans.sqltext import even, fx

P = fx("fx_points").rstrip()
PLANE_STEP = 2.0


def nodes_sql(name: str, where: str, res: float, margin: float) -> str:
    ext = ", ".join(f"floor(min({c})) - {margin} AS lo_{c}, ceil(max({c})) + {margin} AS hi_{c}" for c in "xy")
    num = ", ".join(f"CAST(ceil((hi_{c} - lo_{c}) / CAST({res} AS DOUBLE)) AS BIGINT) AS n_{c}" for c in "xy")
    return f"""{name}_b AS (SELECT *, {num} FROM (SELECT plot_id, {ext} FROM fx_points WHERE {where} GROUP BY plot_id)),
{name} AS (SELECT plot_id, gx * (n_y + 1) + gy AS node_id, gx, gy, lo_x + gx * (hi_x - lo_x) / n_x AS x, lo_y + gy * (hi_y - lo_y) / n_y AS y
  FROM (SELECT *, unnest(range(0, n_y + 1)) AS gy FROM (SELECT *, unnest(range(0, n_x + 1)) AS gx FROM {name}_b)))"""


PAIR = "sqrt((p.x - n.x) * (p.x - n.x) + (p.y - n.y) * (p.y - n.y))"
DTM = f""", {nodes_sql('nodes', 'label = 1', 1.0, 3)},
tp AS (SELECT n.plot_id, node_id, p.z, {PAIR} AS d FROM nodes n JOIN fx_points p ON n.plot_id = p.plot_id AND label = 1 AND abs(p.x - n.x) <= 6 AND abs(p.y - n.y) <= 6),
tc AS (SELECT plot_id, node_id, count(*) FILTER (d <= 3) AS c3, count(*) FILTER (d <= 4) AS c4, count(*) FILTER (d <= 5) AS c5, count(*) FILTER (d <= 6) AS c6 FROM tp GROUP BY plot_id, node_id),
tr AS (SELECT plot_id, node_id, CASE WHEN c3 > 100 THEN 3 WHEN c4 > 100 THEN 4 WHEN c5 > 100 THEN 5 ELSE 6 END AS r FROM tc WHERE c3 > 100 OR c4 > 100 OR c5 > 100 OR c6 >= 100),
tz AS (SELECT plot_id, node_id, quantile_cont(z, 0.2) AS z FROM tp JOIN tr USING (plot_id, node_id) WHERE d <= r GROUP BY plot_id, node_id),
open AS (SELECT n.* FROM nodes n ANTI JOIN tr USING (plot_id, node_id)),
ap AS (SELECT n.plot_id, node_id, p.z, {PAIR} AS d FROM open n JOIN fx_points p ON n.plot_id = p.plot_id),
ar AS (SELECT plot_id, node_id, greatest(6, 6 + ceil((list_max(min(d, 101)) - 6) / 1)) AS r FROM ap GROUP BY plot_id, node_id),
az AS (SELECT plot_id, node_id, quantile_cont(z, 0.025) AS z FROM ap JOIN ar USING (plot_id, node_id) WHERE d <= r GROUP BY plot_id, node_id),
dtm AS (SELECT n.plot_id, node_id, n.x, n.y, {even('z', 6)} AS z FROM nodes n JOIN (SELECT * FROM tz UNION ALL SELECT * FROM az) USING (plot_id, node_id))"""


@query("A1_make_dtm", P + DTM + " SELECT * FROM dtm")
def _(v):
    return te.make_dtm(v.points, None, 1.0).select("plot_id", "node_id", "x", "y", half_even(F.col("z"), 6).alias("z"))


@query("A1_make_dtm_cropped", fx("fx_points", "fx_plots").rstrip() + DTM + """ SELECT dtm.plot_id, node_id, x, y, z FROM dtm JOIN fx_plots p ON dtm.plot_id = p.plot_id
WHERE sqrt((x - cx) * (x - cx) + (y - cy) * (y - cy)) <= plot_radius + plot_radius_buffer""")
def _(v):
    return te.make_dtm(v.points, v.plots, 1.0).select("plot_id", "node_id", "x", "y", half_even(F.col("z"), 6).alias("z"))


MIRROR = "least({i}, 2 * {n} - 1 - {i})"


def _mirror(c: str) -> str:
    n = f"(hi_{c} - lo_{c} + 1)"
    i = f"((({c} - lo_{c} + o{c}) % (2 * {n}) + 2 * {n}) % (2 * {n}))"
    return f"least({i}, 2 * {n} - 1 - {i}) + lo_{c}"


DEM = f""", cells AS (SELECT *, CAST(floor(x / CAST(2 AS DOUBLE)) AS BIGINT) AS cx, CAST(floor(y / CAST(2 AS DOUBLE)) AS BIGINT) AS cy FROM fx_points),
val AS (SELECT c.plot_id, c.cx, c.cy, max(z) AS v FROM cells c JOIN (SELECT plot_id, cx, cy, median(z) AS m FROM cells WHERE label = 1 GROUP BY ALL) k
  ON c.plot_id = k.plot_id AND c.cx = k.cx AND c.cy = k.cy AND c.label = 1 AND c.z = k.m GROUP BY ALL),
rast AS (SELECT *, unnest(range(lo_cy, hi_cy + 1)) AS cy FROM (SELECT *, unnest(range(lo_cx, hi_cx + 1)) AS cx FROM
  (SELECT plot_id, min(cx) AS lo_cx, max(cx) AS hi_cx, min(cy) AS lo_cy, max(cy) AS hi_cy FROM cells GROUP BY plot_id))),
off AS (SELECT h AS half, ocx, unnest(range(-h, h + 1)) AS ocy FROM (SELECT h, unnest(range(-h, h + 1)) AS ocx FROM (SELECT unnest(range(1, 9)) AS h))),
wide AS (SELECT r.plot_id, cx, cy, half, {_mirror('cx')} AS wx, {_mirror('cy')} AS wy FROM rast r, off),
win AS (SELECT w.plot_id, w.cx, w.cy, half, median(v) AS zz FROM wide w LEFT JOIN val ON w.plot_id = val.plot_id AND wx = val.cx AND wy = val.cy GROUP BY ALL),
size AS (SELECT plot_id, min(half) AS half FROM (SELECT plot_id, half, count(*) FILTER (zz IS NULL) AS gaps FROM win GROUP BY ALL) WHERE gaps = 0 GROUP BY plot_id),
dem AS (SELECT plot_id, cx * CAST(2 AS DOUBLE) AS xx, cy * CAST(2 AS DOUBLE) AS yy, zz FROM win JOIN size USING (plot_id, half))"""


@query("A2_make_dem", P + DEM + " SELECT plot_id, xx, yy, " + even("zz", 6) + " AS zz FROM dem")
def _(v):
    return te.make_dem(v.points, 2.0).withColumn("zz", half_even(F.col("zz"), 6))


CELL = "floor(x / CAST(2 AS DOUBLE)) * 2 AS xx, floor(y / CAST(2 AS DOUBLE)) * 2 AS yy"


@query("J15_dem_map", P + DEM + f" SELECT p.plot_id, point_id, {even('z - zz', 6)} AS n_z FROM (SELECT *, {CELL} FROM fx_points) p LEFT JOIN dem USING (plot_id, xx, yy)")
def _(v):
    out = te.dem_map(v.points, te.make_dem(v.points, 2.0), 2.0)
    return out.select("plot_id", "point_id", half_even(F.col("n_z"), 6).alias("n_z"))


@query("J15_dem_map_outer", fx("fx_points", "fx_dtm").rstrip() + f" SELECT plot_id, xx, yy, point_id, zz FROM (SELECT *, {CELL} FROM fx_points) p FULL JOIN (SELECT plot_id, x AS xx, y AS yy, z AS zz FROM fx_dtm) USING (plot_id, xx, yy)")
def _(v):
    dem = v.dtm.select("plot_id", F.col("x").alias("xx"), F.col("y").alias("yy"), F.col("z").alias("zz"))
    return te.dem_map(v.points, dem, 2.0, how="full").select("plot_id", "xx", "yy", "point_id", "zz")


@query("J2_hag_nearest", fx("fx_points", "fx_dtm") + f"""SELECT plot_id, point_id, {even('z - ground', 6)} AS hag FROM (
SELECT p.plot_id, point_id, p.z, n.z AS ground, row_number() OVER (PARTITION BY point_id ORDER BY {even(PAIR, 9)}, n.x / 2 <> round_even(p.x / 2, 0), n.y / 2 <> round_even(p.y / 2, 0)) AS r
FROM fx_points p JOIN fx_dtm n ON p.plot_id = n.plot_id AND abs(p.x - n.x) <= 8 AND abs(p.y - n.y) <= 8) WHERE r = 1""")
def _(v):
    return te.hag_nearest(v.points.drop("hag"), v.dtm, PLANE_STEP).select("plot_id", "point_id", half_even(F.col("hag"), 6).alias("hag"))


CORNERS = " ".join(
    f"LEFT JOIN fx_dtm n{a}{b} ON c.plot_id = n{a}{b}.plot_id AND n{a}{b}.gx = floor(c.x / 2) + {a} + 10 AND n{a}{b}.gy = floor(c.y / 2) + {b} + 10" for a in (0, 1) for b in (0, 1)
)


@query("J3_hag_linear", fx("fx_cylinders", "fx_dtm").rstrip() + f""", med AS (SELECT plot_id, median(z) AS m FROM fx_dtm GROUP BY plot_id)
SELECT c.plot_id, cyl_id, {even('c.z - coalesce(CASE WHEN n00.z IS NOT NULL AND n11.z IS NOT NULL THEN CASE WHEN tx >= ty THEN n00.z + tx * (n10.z - n00.z) + ty * (n11.z - n10.z) ELSE n00.z + ty * (n01.z - n00.z) + tx * (n11.z - n01.z) END WHEN tx + ty <= 1 THEN n00.z + tx * (n10.z - n00.z) + ty * (n01.z - n00.z) ELSE n11.z + (1 - tx) * (n01.z - n11.z) + (1 - ty) * (n10.z - n11.z) END, m)', 6)} AS hag
FROM (SELECT *, x / 2 - floor(x / 2) AS tx, y / 2 - floor(y / 2) AS ty FROM fx_cylinders) c {CORNERS} LEFT JOIN med ON med.plot_id = c.plot_id""")
def _(v):
    return te.hag_linear(v.cylinders, v.dtm, PLANE_STEP).select("plot_id", "cyl_id", half_even(F.col("hag"), 6).alias("hag"))


MINK = "pow(pow(abs(p.x - n.x), 10) + pow(abs(p.y - n.y), 10), 0.1)"


@query("J4_radius_count", P + f""", {nodes_sql('nodes', 'label = 1', 1.0, 0)},
c AS (SELECT n.plot_id, node_id, count(*) FILTER (label = 2) AS n_veg, count(*) FILTER (label = 3) AS n_cwd FROM nodes n JOIN fx_points p
  ON n.plot_id = p.plot_id AND abs(p.x - n.x) <= 0.7 AND abs(p.y - n.y) <= 0.7 AND {MINK} <= 0.7 GROUP BY ALL)
SELECT plot_id, node_id, coalesce(n_veg, 0) AS n_veg, coalesce(n_cwd, 0) AS n_cwd FROM nodes LEFT JOIN c USING (plot_id, node_id)""")
def _(v):
    nodes = te.grid_nodes(v.points.filter("label = 1"), 1.0, 0.0)
    return te.node_counts(nodes, v.points, 0.7, {"n_veg": F.col("label") == 2, "n_cwd": F.col("label") == 3})


@query("J5_ground_radius_grow", P + DTM + " SELECT plot_id, node_id, z FROM dtm")
def _(v):
    terrain = v.points.filter("label = 1")
    out = te.ground_heights(te.grid_nodes(terrain, 1.0), terrain, v.points, 1.0)
    return out.select("plot_id", "node_id", half_even(F.col("z"), 6).alias("z"))


# edges p -> q of the hull: no extreme point to the right, none beyond q or before p on the same line
HULL = """, ext AS (SELECT plot_id, x, unnest([min(y), max(y)]) AS y FROM fx_dtm GROUP BY plot_id, x),
pts AS (SELECT DISTINCT plot_id, x, y FROM ext),
edge AS (SELECT p.plot_id, p.x, p.y, q.x AS x2, q.y AS y2 FROM pts p JOIN pts q ON p.plot_id = q.plot_id AND (p.x <> q.x OR p.y <> q.y)
  JOIN pts r ON r.plot_id = p.plot_id GROUP BY ALL
  HAVING bool_and((q.x - p.x) * (r.y - p.y) - (q.y - p.y) * (r.x - p.x) > 0
    OR ((q.x - p.x) * (r.y - p.y) - (q.y - p.y) * (r.x - p.x) = 0 AND (r.x - p.x) * (r.x - q.x) + (r.y - p.y) * (r.y - q.y) <= 0)))"""


@query("A13_convex_hull", fx("fx_dtm").rstrip() + HULL + " SELECT plot_id, x, y FROM edge")
def _(v):
    return te.convex_hull(v.dtm.select("plot_id", "x", "y")).select("plot_id", "x", "y")


@query("A13_inside_hull", fx("fx_points", "fx_dtm").rstrip() + HULL + """ SELECT p.plot_id, point_id FROM fx_points p JOIN edge e ON p.plot_id = e.plot_id GROUP BY p.plot_id, point_id
HAVING bool_and(((e.y2 - e.y) * (p.x - e.x) - (e.x2 - e.x) * (p.y - e.y)) / sqrt((e.x2 - e.x) * (e.x2 - e.x) + (e.y2 - e.y) * (e.y2 - e.y)) <= 1e-5)""")
def _(v):
    return te.inside_hull(v.points, te.convex_hull(v.dtm.select("plot_id", "x", "y"))).select("plot_id", "point_id")


@query("A12_plot_area", fx("fx_dtm", "fx_plots").rstrip() + HULL + f""", area AS (SELECT plot_id, sum(x * y2 - x2 * y) / 2 AS a FROM edge GROUP BY plot_id)
SELECT p.plot_id, plot_radius, {even(f"CASE WHEN plot_radius > 0 THEN {even('pi() * plot_radius * plot_radius / 10000', 3)} ELSE a / 10000 END", 6)} AS area_ha
FROM (SELECT plot_id, CASE WHEN plot_id % 2 = 0 THEN 0 ELSE plot_radius END AS plot_radius FROM fx_plots) p LEFT JOIN area ON area.plot_id = p.plot_id""")
def _(v):
    plots = v.plots.select("plot_id", F.when(F.col("plot_id") % 2 == 0, 0.0).otherwise(F.col("plot_radius")).alias("plot_radius"))
    return te.plot_area(plots, v.dtm).withColumn("area_ha", half_even(F.col("area_ha"), 6))


@query("A11_veg_coverage", fx("fx_points", "fx_dtm").rstrip() + HULL + f""", {nodes_sql('nodes', 'label = 1', 0.5, 0)},
inn AS (SELECT n.plot_id, node_id, n.x, n.y FROM nodes n JOIN edge e ON n.plot_id = e.plot_id GROUP BY ALL
  HAVING bool_and(((e.y2 - e.y) * (n.x - e.x) - (e.x2 - e.x) * (n.y - e.y)) / sqrt((e.x2 - e.x) * (e.x2 - e.x) + (e.y2 - e.y) * (e.y2 - e.y)) <= 1e-5)),
c AS (SELECT n.plot_id, node_id, count(*) FILTER (label = 2 AND hag > 0.8) AS a, count(*) FILTER ((label = 2 AND hag <= 0.8) OR (label = 4 AND hag <= 0.4)) AS b, count(*) FILTER (label = 3) AS c
  FROM inn n JOIN fx_points p ON n.plot_id = p.plot_id AND abs(p.x - n.x) <= 0.5 AND abs(p.y - n.y) <= 0.5 AND {MINK} <= 0.5 GROUP BY ALL)
SELECT plot_id, count(*) AS n_nodes, {', '.join(f"{even(f'avg(CASE WHEN coalesce({k}, 0) > 5 THEN 1.0 ELSE 0.0 END)', 9)} AS {n}_fraction" for k, n in (('a', 'canopy'), ('b', 'understory'), ('c', 'cwd')))}
FROM inn LEFT JOIN c USING (plot_id, node_id) GROUP BY plot_id""")
def _(v):
    out = te.vegetation_coverage(v.points, v.dtm, 0.5)
    return out.select("plot_id", "n_nodes", *[half_even(F.col(f"{n}_fraction"), 9).alias(f"{n}_fraction") for n in ("canopy", "understory", "cwd")])


@query("A21_plot_gradient", fx("fx_dtm") + f"""SELECT plot_id, {even('degrees(atan(sqrt(a * a + b * b)))', 4)} AS avg_gradient, {even('degrees(atan(abs(a)))', 4)} AS avg_gradient_x, {even('degrees(atan(abs(b)))', 4)} AS avg_gradient_y
FROM (SELECT plot_id, (xz * yy - yz * xy) / (xx * yy - xy * xy) AS a, (yz * xx - xz * xy) / (xx * yy - xy * xy) AS b FROM (
  SELECT plot_id, var_pop(x) AS xx, covar_pop(x, y) AS xy, var_pop(y) AS yy, covar_pop(x, z) AS xz, covar_pop(y, z) AS yz FROM fx_dtm GROUP BY plot_id))""")
def _(v):
    out = te.plot_gradient(v.dtm)
    return out.select("plot_id", *[half_even(F.col(c), 4).alias(c) for c in out.columns if c != "plot_id"])
