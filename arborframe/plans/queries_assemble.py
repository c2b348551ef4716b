"""Segment linking, roots, leaders and smoothing queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from arborframe.functions.numeric import half_even
from arborframe.operators import assemble as ab
from arborframe.operators import graph as gr
from arborframe.plans.registry import query
from arborframe.plans.sqltext import even, fx

C = fx("fx_cylinders").rstrip()
# the three branches of a tree on top of each other, the second leaning away
STACK = C + """, cyl AS (SELECT * REPLACE (z / 3 + floor(branch_id / CAST(50 AS DOUBLE)) * 8 AS z, x + floor(branch_id / CAST(50 AS DOUBLE)) * CAST(0.2 AS DOUBLE) AS x) FROM fx_cylinders)"""


def stacked(v):
    level = F.floor(F.col("branch_id") / 50.0)
    return v.cylinders.withColumns({"z": F.col("z") / 3 + level * 8, "x": F.col("x") + level * 0.2})


ANGLE = "degrees(acos(least(greatest((ax * bx + ay * b_y + az * bz) / (sqrt(ax * ax + ay * ay + az * az) * sqrt(bx * bx + b_y * b_y + bz * bz)), -1), 1)))"


def angle(a: tuple[str, str, str], b: tuple[str, str, str]) -> str:
    out = ANGLE
    for k, e in zip(("ax", "ay", "az", "bx", "b_y", "bz"), (*a, *b)):
        out = out.replace(k, f"({e})")
    return out


LINKS = STACK + f""", rk AS (SELECT *, row_number() OVER (PARTITION BY plot_id, branch_id ORDER BY z, cyl_id) AS r, count(*) OVER (PARTITION BY plot_id, branch_id) AS n FROM cyl),
e AS (SELECT l.plot_id, l.branch_id, l.x, l.y, l.z, l.nx, l.ny, l.nz, l.n, (l.x + s.x) / 2 AS mx, (l.y + s.y) / 2 AS my, (l.z + s.z) / 2 AS mz FROM rk l JOIN rk s ON l.plot_id = s.plot_id AND l.branch_id = s.branch_id AND l.r = 1 AND s.r = 2 WHERE l.n >= 5),
pr AS (SELECT e.plot_id, e.branch_id, e.n, c.branch_id AS parent_branch_id, c.cyl_id AS parent_cyl_id, sqrt((c.x - e.x) * (c.x - e.x) + (c.y - e.y) * (c.y - e.y) + (c.z - e.z) * (c.z - e.z)) AS dist,
  {angle(('e.x - c.x', 'e.y - c.y', 'e.z - c.z'), ('e.nx', 'e.ny', 'e.nz'))} AS a1, {angle(('e.mx - c.x', 'e.my - c.y', 'e.mz - c.z'), ('0', '0', '1'))} AS a2
  FROM e JOIN cyl c ON e.plot_id = c.plot_id AND e.branch_id <> c.branch_id AND c.z < e.z - 0.1 AND abs(c.x - e.x) <= 2 AND abs(c.y - e.y) <= 2 AND c.z >= e.z - 2),
h AS (SELECT *, dist <= 0.5 AND a1 < 90 AS h1, a2 <= 20 AS h2 FROM pr WHERE dist <= 2),
ph AS (SELECT plot_id, branch_id, bool_or(h1) AS p1, bool_or(h2) AS p2 FROM h GROUP BY ALL),
pk AS (SELECT h.*, CASE WHEN p1 THEN 1 ELSE 2 END AS phase FROM h JOIN ph USING (plot_id, branch_id) WHERE (p1 OR p2) AND (CASE WHEN n > 10 THEN CASE WHEN p1 THEN h1 ELSE h2 END WHEN p1 THEN dist <= 0.5 ELSE TRUE END)
  QUALIFY row_number() OVER (PARTITION BY h.plot_id, h.branch_id ORDER BY dist, parent_cyl_id) = 1)
SELECT plot_id, branch_id, phase, parent_branch_id, parent_cyl_id, {even('dist', 6)} AS dist FROM pk WHERE n > 10 OR dist < 1.2"""


@query("J11_segment_parent", LINKS)
def _(v):
    return ab.segment_parents(stacked(v))[0].withColumn("dist", half_even(F.col("dist"), 6))


FAR = STACK + f""", rk AS (SELECT *, row_number() OVER (PARTITION BY plot_id, branch_id ORDER BY z, cyl_id) AS r, count(*) OVER (PARTITION BY plot_id, branch_id) AS n FROM cyl), e AS (SELECT * FROM rk WHERE r = 1 AND n >= 5),
pr AS (SELECT e.plot_id, e.branch_id, c.branch_id AS parent_branch_id, c.cyl_id AS parent_cyl_id, sqrt((c.x - e.x) * (c.x - e.x) + (c.y - e.y) * (c.y - e.y) + (c.z - e.z) * (c.z - e.z)) AS dist, {angle(('e.x - c.x', 'e.y - c.y', 'e.z - c.z'), ('e.nx', 'e.ny', 'e.nz'))} AS a
  FROM e JOIN cyl c ON e.plot_id = c.plot_id AND e.branch_id <> c.branch_id AND c.z < e.z - 0.1 AND abs(c.x - e.x) <= 1 AND abs(c.y - e.y) <= 1 AND c.z >= e.z - 1)
SELECT plot_id, branch_id, 3 AS phase, parent_branch_id, parent_cyl_id, {even('dist', 6)} AS dist FROM pr WHERE dist <= 1 AND a < 120 QUALIFY row_number() OVER (PARTITION BY plot_id, branch_id ORDER BY dist, parent_cyl_id) = 1"""


@query("J12_segment_parent_far", FAR)
def _(v):
    cyl = stacked(v)
    ends = ab.segment_ends(cyl)
    return ab.far_parents(ends, cyl, 0.5).withColumn("dist", half_even(F.col("dist"), 6))


SEG = fx("fx_segments").rstrip().replace("WITH ", "WITH RECURSIVE ", 1)


@query("C5_root_resolution", SEG + """, up(branch_id, cur) AS (SELECT branch_id, branch_id FROM fx_segments UNION ALL SELECT u.branch_id, s.parent_branch_id FROM up u JOIN fx_segments s ON s.branch_id = u.cur AND s.parent_branch_id <> u.cur)
SELECT branch_id, min(cur) AS root FROM up GROUP BY branch_id""")
def _(v):
    return gr.resolve_roots(v.segments, "branch_id", "parent_branch_id").select("branch_id", "root")


@query("C6_trace_skeleton", SEG + """, tr(start_id, step, branch_id, base_top) AS (SELECT branch_id, 0, branch_id, z_min / 2 FROM fx_segments UNION ALL
SELECT start_id, step + 1, nxt, base_top FROM (SELECT t.start_id, t.step, s.branch_id AS nxt, t.base_top, row_number() OVER (PARTITION BY t.start_id, t.step ORDER BY s.mean_radius DESC, s.branch_id) AS r
  FROM tr t JOIN fx_segments s ON s.parent_branch_id = t.branch_id AND s.branch_id <> t.branch_id AND s.z_min >= t.base_top) WHERE r = 1)
SELECT start_id, CAST(step AS INT) AS step, branch_id FROM tr""")
def _(v):
    starts = v.segments.select("plot_id", F.col("branch_id").alias("start_id"), (F.col("z_min") / 2).alias("base_top"))
    return gr.trace_paths(v.segments, starts)[0].select("start_id", "step", "branch_id")


@query("C8_tree_gate", C + """, low AS (SELECT plot_id, tree_id, height_above_dtm AS base FROM fx_cylinders QUALIFY row_number() OVER (PARTITION BY plot_id, tree_id ORDER BY z, cyl_id) = 1),
f AS (SELECT plot_id, tree_id, count(*) AS n, max(height_above_dtm) AS top FROM fx_cylinders GROUP BY ALL)
SELECT plot_id, cyl_id FROM fx_cylinders SEMI JOIN (SELECT plot_id, tree_id FROM f JOIN low USING (plot_id, tree_id) WHERE n >= 74 AND base <= 0.3 AND top >= 4) USING (plot_id, tree_id)""")
def _(v):
    return ab.tree_gate(v.cylinders, 74, 0.3, 4.0).select("plot_id", "cyl_id")


@query("C7_leaders")
def _(v):
    return ab.leaders(stacked(v), 7.5).select("plot_id", "cyl_id", "branch_id", "tree_id", "main_stem")


MARKED = C + """, fr AS (SELECT *, branch_id AS final_tree, CASE WHEN branch_id >= 100 THEN 0 ELSE main_stem END AS stem FROM fx_cylinders),
loose AS (SELECT * FROM fr WHERE stem = 0 QUALIFY row_number() OVER (PARTITION BY plot_id, tree_id, branch_id ORDER BY z, cyl_id) = 1)
SELECT a.plot_id, a.tree_id, a.branch_id, b.final_tree AS leader_tree FROM loose a JOIN fr b ON a.plot_id = b.plot_id AND a.tree_id = b.tree_id AND b.stem > 0
QUALIFY row_number() OVER (PARTITION BY a.plot_id, a.tree_id, a.branch_id ORDER BY sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) + (a.z - b.z) * (a.z - b.z)), b.cyl_id) = 1"""


@query("J13_nearest_leader", MARKED)
def _(v):
    rows = v.cylinders.withColumn("final_tree", F.col("branch_id")).withColumn("main_stem", F.when(F.col("branch_id") >= 100, 0).otherwise(F.col("main_stem")))
    return ab.nearest_leader(rows)


def median_sql(column: str, size: int) -> str:
    h = size // 2
    at = "((i - 1 + o) % (2 * n) + 2 * n) % (2 * n)"
    return C + f""", rk AS (SELECT plot_id, tree_id, cyl_id, {column} AS val, row_number() OVER w AS i, count(*) OVER (PARTITION BY plot_id, tree_id) AS n FROM fx_cylinders WHERE main_stem > 0 WINDOW w AS (PARTITION BY plot_id, tree_id ORDER BY z, cyl_id)),
wd AS (SELECT plot_id, tree_id, cyl_id, least({at}, 2 * n - 1 - {at}) + 1 AS j FROM (SELECT *, unnest(range(-{h}, {h + 1})) AS o FROM rk))
SELECT w.plot_id, w.tree_id, w.cyl_id, {even('median(r.val)', 3)} AS value FROM wd w JOIN rk r ON r.plot_id = w.plot_id AND r.tree_id = w.tree_id AND r.i = w.j GROUP BY ALL"""


@query("W1_median_filter_radius", median_sql("radius", 5))
def _(v):
    out = ab.median_filter(v.cylinders.filter("main_stem > 0"), "radius", 5)
    return out.withColumn("value", half_even(F.col("value"), 3))


@query("W2_median_filter_xy", median_sql("x", 7))
def _(v):
    out = ab.median_filter(v.cylinders.filter("main_stem > 0"), "x", 7)
    return out.withColumn("value", half_even(F.col("value"), 3))


GROUND = C + f""", lo AS (SELECT *, z - height_above_dtm + 0.2 AS zg FROM fx_cylinders WHERE main_stem > 0 QUALIFY row_number() OVER (PARTITION BY plot_id, tree_id ORDER BY z, cyl_id) = 1),
k AS (SELECT *, unnest(range(1, CASE WHEN n <= 1 OR z < zg THEN 2 ELSE n END)) AS k FROM (SELECT *, CAST(ceil(sqrt((z - zg) * (z - zg)) / 0.01::DOUBLE) AS BIGINT) AS n FROM lo))
SELECT plot_id, tree_id, {even('CASE WHEN n <= 1 THEN (z + zg) / 2 WHEN z < zg THEN z ELSE z + (zg - z) * k / n END', 6)} AS z, radius, CASE WHEN n <= 1 THEN 0.2 WHEN z < zg THEN {even('height_above_dtm', 6)} ELSE 0 END AS height_above_dtm FROM k"""


@query("W8_to_ground", GROUND)
def _(v):
    out = ab.to_ground(v.cylinders, 0.01)
    return out.select("plot_id", "tree_id", half_even(F.col("z"), 6).alias("z"), "radius", half_even(F.col("height_above_dtm"), 6).alias("height_above_dtm"))


GROW = C.replace("WITH ", "WITH RECURSIVE ", 1) + f""", re AS (SELECT c.plot_id, c.cyl_id, p.cyl_id AS pid, p.z AS pz FROM fx_cylinders c JOIN fx_cylinders p ON c.plot_id = p.plot_id AND abs(c.x - p.x) <= 0.6 AND abs(c.y - p.y) <= 0.6 AND abs(c.z - p.z) <= 0.6
  AND (c.z > p.z OR (c.z = p.z AND c.cyl_id > p.cyl_id)) AND sqrt((c.x - p.x) * (c.x - p.x) + (c.y - p.y) * (c.y - p.y) + (c.z - p.z) * (c.z - p.z)) <= 0.6 AND c.radius < p.radius * 1.05
  AND {angle(('p.nx', 'p.ny', 'p.nz'), ('c.nx', 'c.ny', 'c.nz'))} <= 10),
pa AS (SELECT plot_id, cyl_id, pid FROM re QUALIFY row_number() OVER (PARTITION BY plot_id, cyl_id ORDER BY pz DESC, pid DESC) = 1),
up(plot_id, cyl_id, cur, d) AS (SELECT plot_id, cyl_id, cyl_id, 0 FROM fx_cylinders UNION ALL SELECT u.plot_id, u.cyl_id, pa.pid, d + 1 FROM up u JOIN pa ON pa.plot_id = u.plot_id AND pa.cyl_id = u.cur),
ro AS (SELECT plot_id, cyl_id, cur AS root FROM up QUALIFY row_number() OVER (PARTITION BY plot_id, cyl_id ORDER BY d DESC) = 1),
st AS (SELECT plot_id, cyl_id AS root, row_number() OVER (PARTITION BY plot_id ORDER BY z, cyl_id) AS tree_id FROM fx_cylinders ANTI JOIN pa USING (plot_id, cyl_id))
SELECT r.plot_id, r.cyl_id, st.tree_id FROM ro r JOIN st ON st.plot_id = r.plot_id AND st.root = r.root SEMI JOIN (SELECT DISTINCT plot_id, pid AS cyl_id FROM re) a ON a.plot_id = r.plot_id AND a.cyl_id = r.cyl_id"""


@query("J17_cylinder_grow_sort", GROW)
def _(v):
    return ab.grow_from_lowest(v.cylinders, 0.6, 10.0).select("plot_id", "cyl_id", "tree_id")


@query("J18_branch_gap_interp")
def _(v):
    return ab.fill_branch_gaps(v.cylinders, 0.5).select("plot_id", "tree_id", "branch_id", *[half_even(F.col(c), 6).alias(c) for c in "xyz"], "radius")
