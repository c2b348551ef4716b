"""Scalar geometry, clock and table-generating queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from arborframe.functions import clock
from arborframe.functions import geometry as geo
from arborframe.functions.numeric import half_even
from arborframe.lineage import cut_lineage
from arborframe.operators import shapes as sh
from arborframe.plans.queries_measure import TREES, tree_frame
from arborframe.plans.registry import query
from arborframe.plans.sqltext import even, fx

C = fx("fx_cylinders")


def normal():
    return [F.col(c) for c in ("nx", "ny", "nz")]


def position():
    return [F.col(c) for c in "xyz"]


def r(c, n=6):
    return half_even(c, n)


@query("M1_distance_bearing", fx("fx_points", "fx_plots") + f"""SELECT p.plot_id, point_id, {even('sqrt((x - cx) * (x - cx) + (y - cy) * (y - cy))', 2)} AS distance,
(({even('degrees(atan2(x - cx, y - cy))')} % 360) + 360) % 360 AS bearing FROM fx_points p JOIN fx_plots USING (plot_id)""")
def _(v):
    j = v.points.join(v.plots, "plot_id")
    at = [F.col(c) for c in ("x", "y", "cx", "cy")]
    return j.select("plot_id", "point_id", geo.distance_xy(*at).alias("distance"), geo.bearing(*at).alias("bearing"))


@query("M2_polar_to_xy", fx("fx_field_trees") + f"SELECT tree_id, {even('distance * sin(radians(bearing))', 3)} AS x, {even('distance * cos(radians(bearing))', 3)} AS y FROM fx_field_trees")
def _(v):
    x, y = geo.polar_to_xy(F.col("distance"), F.col("bearing"))
    return v.field_trees.select("tree_id", x.alias("x"), y.alias("y"))


NN, XN = "sqrt(nx * nx + ny * ny + nz * nz)", "sqrt(x * x + y * y + z * z)"
COS = f"((nx * x + ny * y + nz * z) / ({NN} * {XN}))"
ACOS = f"degrees(acos(least(greatest({COS}, -1), 1)))"


@query("M3_inner_angle", C + f"SELECT cyl_id, {even(ACOS, 4)} AS angle FROM fx_cylinders")
def _(v):
    return v.cylinders.select("cyl_id", r(geo.inner_angle(normal(), position()), 4).alias("angle"))


@query("M4_compute_angle", C + f"SELECT cyl_id, {even(ACOS, 4)} AS angle FROM fx_cylinders")
def _(v):
    return v.cylinders.select("cyl_id", r(geo.compute_angle(normal(), position()), 4).alias("angle"))


@query("M6_rodrigues", C + f"""SELECT cyl_id, {even('x * c + (ky * z - kz * y) * s + kx * kp * (1 - c)', 6)} AS rx, {even('y * c + (kz * x - kx * z) * s + ky * kp * (1 - c)', 6)} AS ry, {even('z * c + (kx * y - ky * x) * s + kz * kp * (1 - c)', 6)} AS rz
FROM (SELECT *, kx * x + ky * y + kz * z AS kp FROM (SELECT *, CASE WHEN h > 0 THEN ny / h ELSE 0 END AS kx, CASE WHEN h > 0 THEN -nx / h ELSE 0 END AS ky, 0 AS kz, nz / {NN} AS c, sqrt(1 - (nz / {NN}) * (nz / {NN})) AS s
  FROM (SELECT *, sqrt(nx * nx + ny * ny) AS h FROM fx_cylinders)))""")
def _(v):
    p = geo.rotate_between(position(), normal(), [F.lit(0.0), F.lit(0.0), F.lit(1.0)])
    return v.cylinders.select("cyl_id", *[r(c).alias(n) for c, n in zip(p, ("rx", "ry", "rz"))])


T7 = "((height_above_dtm - z) / (nz - z))"


@query("M7_point_on_line_at_height", C + f"SELECT cyl_id, {even(f'x + {T7} * (nx - x)', 6)} AS px, {even(f'y + {T7} * (ny - y)', 6)} AS py, CASE WHEN nz <> z THEN height_above_dtm END AS pz FROM (SELECT * REPLACE (CASE WHEN nz = z THEN NULL ELSE nz END AS nz) FROM fx_cylinders)")
def _(v):
    p = geo.point_on_line_at_height(position(), normal(), F.col("height_above_dtm"))
    return v.cylinders.select("cyl_id", r(p[0]).alias("px"), r(p[1]).alias("py"), p[2].alias("pz"))


L8 = "sqrt((nx - x) * (nx - x) + (ny - y) * (ny - y) + (nz - z) * (nz - z))"


@query("M8_point_along", C + "SELECT cyl_id, " + ", ".join(f"{even(f'CASE WHEN {L8} < 1e-10 THEN {c} ELSE {c} + radius * (n{c} - {c}) / {L8} END', 6)} AS p{c}" for c in "xyz") + " FROM fx_cylinders")
def _(v):
    p = geo.point_along(position(), normal(), F.col("radius"))
    return v.cylinders.select("cyl_id", *[r(c).alias(f"p{n}") for c, n in zip(p, "xyz")])


@query("M9_edge_coord", C + f"""SELECT cyl_id, CASE WHEN x < 0 AND y >= 0 THEN 1 WHEN x >= 0 AND y >= 0 THEN 2 WHEN x < 0 AND y < 0 THEN 3 ELSE 4 END AS zone,
{even('x + CASE WHEN x < 0 THEN -1 ELSE 1 END * cci / 101 * radius', 6)} AS ex, {even('y + CASE WHEN y < 0 THEN -1 ELSE 1 END * sqrt(radius * radius - cci / 101 * radius * (cci / 101 * radius))', 6)} AS ey FROM fx_cylinders""")
def _(v):
    ex, ey = geo.edge_coord(F.col("cci") / 101.0, F.col("x"), F.col("y"), F.col("radius"), F.col("x"), F.col("y"))
    return v.cylinders.select("cyl_id", geo.edge_zone(F.col("x"), F.col("y")).alias("zone"), r(ex).alias("ex"), r(ey).alias("ey"))


@query("M10_theta", C + f"""SELECT cyl_id, {even('abs(x) / h', 6)} AS c, {even('degrees(acos(abs(x) / h))', 4)} AS c_deg, {even('y1 / h', 6)} AS s, {even('degrees(acos(y1 / h))', 4)} AS s_deg
FROM (SELECT *, sqrt(h * h - x * x) AS y1 FROM (SELECT *, {XN} AS h FROM fx_cylinders))""")
def _(v):
    c, cd, s, sd = geo.right_triangle_angles(geo.norm(position()), F.abs("x"))
    return v.cylinders.select("cyl_id", r(c).alias("c"), r(cd, 4).alias("c_deg"), r(s).alias("s"), r(sd, 4).alias("s_deg"))


@query("M11_cyl_lean", C + f"SELECT cyl_id, {even(f'degrees(acos(least(greatest((nx * nx + ny * ny + nz * 0.001) / ({NN} * sqrt(nx * nx + ny * ny + 0.000001)), -1), 1)))', 4)} AS lean FROM fx_cylinders")
def _(v):
    return v.cylinders.select("cyl_id", r(geo.lean_to_horizontal(normal()), 4).alias("lean"))


FOLD = f"CASE WHEN {ACOS} > 90 THEN 180 - {ACOS} ELSE {ACOS} END"


@query("J16_within_cone", C + f"SELECT cyl_id, {FOLD} <= 60 AS in_cone, {FOLD} <= 75 AS in_angle FROM fx_cylinders")
def _(v):
    return v.cylinders.select("cyl_id", geo.within_cone(normal(), position(), 60.0).alias("in_cone"), geo.within_angle(normal(), position(), 75.0).alias("in_angle"))


SEP = "(make_date(year(utc), 9, 30) - CAST(dayofweek(make_date(year(utc), 9, 30)) AS INT))"
APR = "(make_date(year(utc), 4, 7) - CAST(dayofweek(make_date(year(utc), 4, 7)) AS INT))"


@query("M12_nzdt_time", fx("fx_gps") + f"""SELECT event_id, local, strftime(local, '%d-%m-%Y %H:%M:%S') AS local_text FROM (
SELECT event_id, utc + CASE WHEN utc >= {SEP}::TIMESTAMP - INTERVAL 10 HOUR OR utc < {APR}::TIMESTAMP - INTERVAL 10 HOUR THEN INTERVAL 13 HOUR ELSE INTERVAL 12 HOUR END AS local FROM fx_gps)""")
def _(v):
    local = clock.nz_local(F.col("utc"))
    return v.gps.select("event_id", local.alias("local"), clock.clock_text(local).alias("local_text"))


@query("M12_nzdt_time_reference", fx("fx_gps") + f"SELECT event_id, utc + CASE WHEN utc >= {SEP}::TIMESTAMP + INTERVAL 2 HOUR THEN INTERVAL 13 HOUR ELSE INTERVAL 12 HOUR END AS local FROM fx_gps")
def _(v):
    return v.gps.select("event_id", clock.nz_local_reference(F.col("utc")).alias("local"))


H = "sqrt(nx * nx + ny * ny)"
RING = f"""(SELECT *, radius * cos(ring_no * (2 * pi() / 14)) AS fx, radius * sin(ring_no * (2 * pi() / 14)) AS fy FROM (SELECT *, CAST(unnest(range(0, 15)) AS INT) AS ring_no,
  CASE WHEN {H} > 0 THEN -ny / {H} ELSE 0 END AS kx, CASE WHEN {H} > 0 THEN nx / {H} ELSE 0 END AS ky, nz / {NN} AS c, sqrt(1 - (nz / {NN}) * (nz / {NN})) AS s FROM fx_cylinders))"""


@query("O1_cylinder_rings", C + f"""SELECT cyl_id, ring_no, {even('x + fx * c + kx * (kx * fx + ky * fy) * (1 - c)', 5)} AS x, {even('y + fy * c + ky * (kx * fx + ky * fy) * (1 - c)', 5)} AS y, {even('z + (kx * fy - ky * fx) * s', 5)} AS z FROM {RING}""")
def _(v):
    out = sh.cylinder_rings(v.cylinders)
    return out.select("cyl_id", "ring_no", *[half_even(F.col(c), 5).alias(c) for c in "xyz"])


@query("O2_line_points", C + f"""SELECT cyl_id, step_no, {', '.join(even(f'{c} + (n{c} - {c}) * CASE WHEN n > 1 THEN step_no / CAST(n - 1 AS DOUBLE) ELSE 0 END', 6) + f' AS {c}' for c in 'xyz')}
FROM (SELECT *, unnest(range(0, n)) AS step_no FROM (SELECT *, CAST(floor({L8} / CAST(2 AS DOUBLE)) AS BIGINT) AS n FROM fx_cylinders))""")
def _(v):
    out = sh.line_points(v.cylinders, 2.0, ("x", "y", "z"), ("nx", "ny", "nz"))
    return out.select("cyl_id", "step_no", *[r(F.col(c)).alias(c) for c in "xyz"])


# neighbouring cylinders of a tree in height order, upper one first in every second pair
PAIRS = """pr AS (SELECT cyl_id, plot_id, tree_id, z AS z1, x AS x1, y AS y1, radius AS r1, cci AS c1, branch_id AS b1, height_above_dtm AS h1, nx AS nx1,
  lead(x) OVER w AS x2, lead(y) OVER w AS y2, lead(z) OVER w AS z2, lead(radius) OVER w AS r2, lead(cci) OVER w AS c2, lead(branch_id) OVER w AS b2, lead(parent_branch_id) OVER w AS q2, lead(height_above_dtm) OVER w AS h2, lead(nx) OVER w AS nx2, parent_branch_id AS q1
  FROM fx_cylinders WINDOW w AS (PARTITION BY plot_id, tree_id ORDER BY (z * 7) % 5, cyl_id))"""
LEN = "sqrt((x1 - x2) * (x1 - x2) + (y1 - y2) * (y1 - y2) + (z1 - z2) * (z1 - z2))"


def _between(a: str, lo_attr: str, hi_attr: str, new: str) -> str:
    return f"CASE WHEN n <= 1 THEN {lo_attr} WHEN z1 < z2 THEN {hi_attr} ELSE {new} END AS {a}"


O4 = fx("fx_cylinders").rstrip() + f""", {PAIRS}, k AS (SELECT *, unnest(range(1, CASE WHEN n <= 1 OR z1 < z2 THEN 2 ELSE n END)) AS k FROM (SELECT *, CAST(ceil({LEN} / CAST(2 AS DOUBLE)) AS BIGINT) AS n FROM pr WHERE x2 IS NOT NULL))
SELECT cyl_id, k - 1 AS step_no, {', '.join(even(f'CASE WHEN n <= 1 THEN ({c}1 + {c}2) / 2 WHEN z1 < z2 THEN {c}1 ELSE {c}1 + ({c}2 - {c}1) * k / n END', 6) + f' AS {c}' for c in 'xyz')},
{even('CASE WHEN n <= 1 THEN nx2 WHEN z1 < z2 THEN nx1 ELSE (x1 - x2) / ' + LEN + ' END', 6)} AS nx,
{_between('radius', 'r2', 'r1', 'CASE WHEN r1 > 0 AND r2 > 0 THEN least(r1, r2) ELSE greatest(r1, r2) END')}, {_between('cci', 'c2', 'c1', 'least(c1, c2)')},
{_between('branch_id', 'b2', 'b1', 'b1')}, {_between('parent_branch_id', 'q2', 'q1', 'b2')}, {_between('height_above_dtm', 'h2', 'h1', '0')} FROM k"""


@query("O4_interpolate_cylinders", O4)
def _(v):
    from pyspark.sql import Window

    c = v.cylinders
    w = Window.partitionBy("plot_id", "tree_id").orderBy(F.expr("(z * 7) % 5"), "cyl_id")
    cols = [n for n in c.columns if n not in ("plot_id", "cyl_id")]
    pairs = c.select("plot_id", "cyl_id", F.struct(*cols).alias("hi"), F.lead(F.struct(*cols)).over(w).alias("lo")).filter("lo IS NOT NULL")
    out = sh.interpolate_cylinders(pairs, 2.0)
    return out.select("cyl_id", "step_no", *[r(F.col(k)).alias(k) for k in ("x", "y", "z", "nx")], "radius", "cci", "branch_id", "parent_branch_id", "height_above_dtm")


# a stand-in alphabet: the real glyph grids are an input table
GLYPH_SQL = """glyphs AS (SELECT ch, r AS row, c AS col FROM (SELECT chr(CAST(32 + i AS INT)) AS ch, i, r, unnest(range(0, 11)) AS c FROM (SELECT i, unnest(range(0, 11)) AS r FROM (SELECT unnest(range(0, 60)) AS i))) WHERE (i * 7 + r * 3 + c * 5) % 4 = 0)"""
LABEL_SQL = """labels AS (SELECT plot_id, tree_id, text, tree_x AS x, tree_y - k * 0.025 AS y, dbh_bin - k * 0.025 AS z, dbh_taper / 1000.0 * 0.2 AS shift FROM (
  SELECT *, unnest([-2, 0, 1, 2, 3, 4]) AS k, unnest([concat('     TREE ID: ', tree_number), concat('        DIAM: ', dbh_taper, 'MM'), concat('   CCI AT BH: ', cci),
    concat('      HEIGHT: ', height, 'M'), concat('      VOLUME 1: ', volume, 'M3'), concat('      VOLUME 2: ', volume_2, 'M3')]) AS text FROM (SELECT *, tree_id AS tree_number FROM trees)))"""


def glyph_frame(v):
    g = v.spark.range(60).withColumnRenamed("id", "i").withColumn("row", F.explode(F.sequence(F.lit(0), F.lit(10)))).withColumn("col", F.explode(F.sequence(F.lit(0), F.lit(10))))
    return g.filter((F.col("i") * 7 + F.col("row") * 3 + F.col("col") * 5) % 4 == 0).select(F.expr("char(32 + i)").alias("ch"), "row", "col")


#: Trees whose labels a task turns into points.
TREES_A_TASK = 10_000


@query("O3_annotate_points", TREES.rstrip() + f""", {GLYPH_SQL}, {LABEL_SQL},
chars AS (SELECT *, unnest(range(0, length(text))) AS i FROM labels)
SELECT plot_id, tree_id, {even('avg(px)', 6)} AS mean_x, {even('avg(py)', 6)} AS mean_y, {even('avg(pz)', 6)} AS mean_z, count(*) AS n FROM (
SELECT plot_id, tree_id, (i * 11 + g.col) * 0.00256 + x + 0.2 + 0.5 * shift AS px, (10 - g.row) * sqrt(0.5) * 0.00256 + y AS py, (10 - g.row) * sqrt(0.5) * 0.00256 + z AS pz
FROM chars c JOIN glyphs g ON g.ch = substr(text, CAST(i AS INT) + 1, 1)) GROUP BY plot_id, tree_id""")
def _(v):
    trees = cut_lineage(tree_frame(v).withColumn("tree_number", F.col("tree_id")))
    # a tree is a short row with thousands of points: by the size of the rows there would be too few tasks
    trees = trees.repartition(1 + trees.count() // TREES_A_TASK, "plot_id", "tree_id")
    # every point is made; a label's points are added up in the task that makes them
    pts = sh.annotate_points(sh.label_lines(trees), glyph_frame(v), sums=True)
    means = [r(F.try_divide(F.sum(s), F.sum(F.when(F.col(s).isNotNull(), F.col("n_points"))))).alias(m) for s, m in zip(("sum_px", "sum_py", "sum_pz"), ("mean_x", "mean_y", "mean_z"))]
    return pts.groupBy("plot_id", "tree_id").agg(*means, F.sum("n_points").alias("n")).filter("n > 0")


@query("O5_tree_description", TREES + """SELECT plot_id, tree_id, concat(chr(10), ' Tree ', tree_id, chr(10), 'Distance:   ', distance, ' m', chr(10), 'Bearing:    ', bearing, ' degrees', chr(10), 'DBH height: ', dbh_bin, ' m', chr(10),
'DBH:        ', dbh_taper, ' mm', chr(10), 'Height:     ', height, ' m', chr(10), 'Volume:     ', volume, ' m^3', chr(10), 'Volume Cone: ', volume_2, ' m^3') AS description FROM trees""")
def _(v):
    return sh.tree_description(tree_frame(v))
