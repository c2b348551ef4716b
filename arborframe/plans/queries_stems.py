"""Slices, clusters, circle fits and skeleton queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from arborframe.functions.numeric import half_even
from arborframe.operators import graph as gr
from arborframe.operators import stems as sm
from arborframe.plans.registry import query
from arborframe.plans.sqltext import even, fx, hash_sql

SC = fx("fx_scan").rstrip()
CUT = dict(increment=0.2, thickness=0.3, single_height=4.0)
TABLE = (15, 10, 5)


def stems(v):
    return v.scan.filter("label = 4")


def ground(v):
    return v.scan.filter("label = 1").select("plot_id", "x", "y", "z")


def slices(v):
    return sm.slice_points(stems(v), **CUT)


SLICES = SC + """, stems AS (SELECT * FROM fx_scan WHERE label = 4),
ext AS (SELECT plot_id, min(z) AS h0, max(z) AS h1 FROM stems GROUP BY plot_id),
cnt AS (SELECT *, h0 + 4.0::DOUBLE AS split, 20 AS n1, CASE WHEN h1 > h0 + 4.0::DOUBLE THEN CAST(ceil((h1 - (h0 + 4.0::DOUBLE)) / (2 * 0.2::DOUBLE)) AS BIGINT) ELSE 0 END AS n2 FROM ext),
hs AS (SELECT plot_id, CAST(i AS INT) AS slice_id, CASE WHEN i < n1 THEN h0 + i * (4.0::DOUBLE / n1) ELSE split + (i - n1) * (CASE WHEN n2 > 1 THEN (h1 - split) / (n2 - 1) ELSE 0.4 END) END AS slice_z
  FROM (SELECT *, unnest(range(0, n1 + n2)) AS i FROM cnt)),
sl AS (SELECT s.plot_id, point_id, x, y, z, slice_id, slice_z FROM stems s JOIN hs ON s.plot_id = hs.plot_id AND z >= slice_z AND z < slice_z + 0.3::DOUBLE)"""


@query("A3_slice_points", SLICES + f" SELECT plot_id, point_id, slice_id, {even('slice_z', 6)} AS slice_z FROM sl")
def _(v):
    return slices(v).select("plot_id", "point_id", "slice_id", half_even(F.col("slice_z"), 6).alias("slice_z"))


THRESH = SLICES + """, rel AS (SELECT plot_id, quantile_cont(z, 0.99) - min(z) AS relief FROM fx_scan WHERE label = 1 GROUP BY plot_id),
th AS (SELECT p.plot_id, slice_id, n_points, CASE least(floor((slice_z - min(slice_z) OVER (PARTITION BY p.plot_id)) / (5 + relief)), 2) WHEN 0 THEN 15 WHEN 1 THEN 10 ELSE 5 END AS threshold
  FROM (SELECT plot_id, slice_id, slice_z, count(*) AS n_points FROM sl GROUP BY ALL) p JOIN rel USING (plot_id))"""


def thresholds(v):
    return sm.slice_thresholds(slices(v), ground(v), TABLE)


@query("A4_slice_threshold", THRESH + " SELECT * FROM th WHERE n_points > threshold")
def _(v):
    return thresholds(v).select("plot_id", "slice_id", "n_points", "threshold")


D3 = "sqrt((p.x - q.x) * (p.x - q.x) + (p.y - q.y) * (p.y - q.y) + (p.z - q.z) * (p.z - q.z))"


@query("C1_sor_filter", SLICES + f""", nn AS (SELECT p.plot_id, p.slice_id, p.point_id, {D3} AS d FROM sl p JOIN sl q ON p.plot_id = q.plot_id AND p.slice_id = q.slice_id AND p.point_id <> q.point_id
  QUALIFY row_number() OVER (PARTITION BY p.plot_id, p.slice_id, p.point_id ORDER BY {D3}, q.point_id) <= 10),
m AS (SELECT plot_id, slice_id, point_id, avg(d) AS d FROM nn GROUP BY ALL),
l AS (SELECT plot_id, slice_id, avg(d) + 0.5 * stddev_pop(d) AS lim FROM m GROUP BY ALL)
SELECT plot_id, slice_id, point_id FROM sl ANTI JOIN (SELECT * FROM m JOIN l USING (plot_id, slice_id) WHERE d > lim) USING (plot_id, slice_id, point_id)""")
def _(v):
    return sm.sor_filter(slices(v)).select("plot_id", "slice_id", "point_id")


def components_sql(nodes: str, edges: str, keys: str) -> str:
    """Smallest reachable node per node; edges hold both directions."""
    on = " AND ".join(f"{{a}}.{k} = {{b}}.{k}" for k in keys.split(", "))
    return f"""WITH RECURSIVE cc({keys}, node, comp) USING KEY ({keys}, node) AS (
  SELECT {keys}, node, node FROM {nodes}
  UNION
  SELECT {', '.join('e.' + k for k in keys.split(', '))}, e.u, min(c.comp) FROM {edges} e JOIN cc c ON {on.format(a='c', b='e')} AND c.node = e.v
    JOIN recurring.cc r ON {on.format(a='r', b='e')} AND r.node = e.u GROUP BY {', '.join('e.' + k for k in keys.split(', '))}, e.u, r.comp HAVING min(c.comp) < r.comp)"""


EPS, SAMPLES, SIZE = 0.15, 4, 10
CLUSTERS = f"""used AS (SELECT sl.*, threshold FROM sl JOIN th USING (plot_id, slice_id) WHERE n_points > threshold),
pr AS (SELECT p.plot_id, p.slice_id, p.point_id AS u, q.point_id AS v FROM used p JOIN used q ON p.plot_id = q.plot_id AND p.slice_id = q.slice_id AND {D3} <= {EPS}),
core AS (SELECT plot_id, slice_id, u AS node FROM pr GROUP BY ALL HAVING count(*) >= {SAMPLES}),
ed AS (SELECT pr.* FROM pr JOIN core a ON a.plot_id = pr.plot_id AND a.slice_id = pr.slice_id AND a.node = u JOIN core b ON b.plot_id = pr.plot_id AND b.slice_id = pr.slice_id AND b.node = v)"""
FOUND = f"""sz AS (SELECT plot_id, slice_id, comp FROM cc JOIN th USING (plot_id, slice_id) GROUP BY plot_id, slice_id, comp, threshold HAVING count(*) >= {SIZE} AND count(*) >= threshold),
cl AS (SELECT plot_id, slice_id, node AS point_id, comp AS cluster_id FROM cc SEMI JOIN sz USING (plot_id, slice_id, comp))"""


def with_components(head: str, cte: str) -> str:
    """Put a recursive component CTE behind ordinary ones."""
    return head.replace("WITH ", "WITH RECURSIVE ", 1) + ", " + cte.removeprefix("WITH RECURSIVE ")


C2 = with_components(THRESH + ", " + CLUSTERS, components_sql("core", "ed", "plot_id, slice_id")) + ", " + FOUND


def clusters(v):
    return sm.slice_clusters(slices(v), thresholds(v), EPS, SAMPLES, SIZE)


@query("C2_slice_cluster", C2 + " SELECT plot_id, slice_id, point_id, cluster_id FROM cl")
def _(v):
    return clusters(v).select("plot_id", "slice_id", "point_id", "cluster_id")


@query("A5_cluster_centre", C2 + f" SELECT plot_id, slice_id, cluster_id, {', '.join(even(even(f'avg({c})', 9), 6) + f' AS {c}' for c in 'xyz')} FROM cl JOIN sl USING (plot_id, slice_id, point_id) GROUP BY plot_id, slice_id, cluster_id")
def _(v):
    out = sm.cluster_centres(clusters(v))
    return out.select("plot_id", "slice_id", "cluster_id", *[half_even(half_even(F.col(c), 9), 6).alias(c) for c in "xyz"])


CYL_EDGES = """pr AS (SELECT p.plot_id, p.cyl_id AS u, q.cyl_id AS v FROM fx_cylinders p JOIN fx_cylinders q ON p.plot_id = q.plot_id AND p.cyl_id <> q.cyl_id AND abs(p.z - q.z) <= 0.15 AND abs(p.x - q.x) <= 0.15 AND """ + D3 + """ <= 0.15),
nd AS (SELECT DISTINCT plot_id, u AS node FROM pr)"""


@query("C3_dbscan", with_components(fx("fx_cylinders").rstrip() + ", " + CYL_EDGES, components_sql("nd", "pr", "plot_id")) + " SELECT plot_id, node AS cyl_id, comp AS cluster_id FROM cc")
def _(v):
    return gr.density_clusters(v.cylinders, 0.15, 2, "cyl_id")


def skeleton(v):
    from arborframe.lineage import cut_lineage

    cl = cut_lineage(clusters(v))
    return cl, sm.cluster_centres(cl)


def segments(v):
    cl, sk = skeleton(v)
    return cl, sm.skeleton_segments(sk, ground(v), 0.3, CUT["single_height"], CUT["increment"])


@query("C4_skeleton_segments")
def _(v):
    return segments(v)[1]


@query("J10_match_skeleton_points")
def _(v):
    cl, seg = segments(v)
    return sm.segment_points(cl, seg)


@query("A9_segment_axis")
def _(v):
    return sm.segment_axes(segments(v)[1])


S = fx("fx_sections").rstrip()
PHI = f"(({even('degrees(atan2(u, v))')} % 360) + 360) % 360"
BY = ("plot_id", "section_id")


@query("A6_polar_inner_shell", S + f" SELECT plot_id, section_id, point_id FROM (SELECT *, u * 1.0 AS uu FROM fx_sections) QUALIFY rank() OVER (PARTITION BY plot_id, section_id, {PHI.replace('u, v', 'v, u')} ORDER BY sqrt(u * u + v * v)) <= 4")
def _(v):
    # axes swapped on both sides: the shell does not depend on where angles start
    rows = v.sections.select(*BY, "point_id", F.col("v").alias("u"), F.col("u").alias("v"))
    return sm.polar_inner_shell(rows, BY).select(*BY, "point_id")


TRIALS = 32
PICK = ", ".join(f"CAST({hash_sql('(sd % 1000003 * 4099 + trial)', 7 + j)} % n AS INT) AS i{j}" for j in range(3))
FIT = S + f""", sz AS (SELECT plot_id, section_id, count(*) AS n, min(point_id) AS sd FROM fx_sections GROUP BY ALL),
nm AS (SELECT *, row_number() OVER (PARTITION BY plot_id, section_id ORDER BY point_id) - 1 AS i FROM fx_sections),
tr AS (SELECT *, {PICK} FROM (SELECT *, unnest(range(0, {TRIALS})) AS trial FROM sz)),
tp AS (SELECT t.plot_id, t.section_id, trial, a.u AS ax, a.v AS ay, b.u AS bx, b.v AS b_y, c.u AS cx, c.v AS cy FROM tr t
  JOIN nm a ON a.plot_id = t.plot_id AND a.section_id = t.section_id AND a.i = i0 JOIN nm b ON b.plot_id = t.plot_id AND b.section_id = t.section_id AND b.i = i1 JOIN nm c ON c.plot_id = t.plot_id AND c.section_id = t.section_id AND c.i = i2),
cd0 AS (SELECT *, 2.0 * (ax * (b_y - cy) + bx * (cy - ay) + cx * (ay - b_y)) AS d, ax * ax + ay * ay AS sa, bx * bx + b_y * b_y AS sb, cx * cx + cy * cy AS sc FROM tp),
cd1 AS (SELECT plot_id, section_id, trial, ax, ay, (sa * (b_y - cy) + sb * (cy - ay) + sc * (ay - b_y)) / d AS cu, (sa * (cx - bx) + sb * (ax - cx) + sc * (bx - ax)) / d AS cv FROM cd0 WHERE abs(d) > 1e-12),
cd AS (SELECT *, sqrt((ax - cu) * (ax - cu) + (ay - cv) * (ay - cv)) AS cr FROM cd1),
sco AS (SELECT s.plot_id, s.section_id, trial, cu, cv, s.u, s.v, abs(sqrt((s.u - cu) * (s.u - cu) + (s.v - cv) * (s.v - cv)) - cr) AS e FROM fx_sections s JOIN cd USING (plot_id, section_id)),
vt AS (SELECT plot_id, section_id, trial, count(*) FILTER (e <= 0.03) AS n_in, {even('sum(e * e)', 6)} AS sq FROM sco GROUP BY ALL),
bs AS (SELECT plot_id, section_id, trial FROM vt QUALIFY row_number() OVER (PARTITION BY plot_id, section_id ORDER BY n_in DESC, sq, trial) = 1 AND n_in >= 3),
mo AS (SELECT plot_id, section_id, count(*) AS n_inliers, avg(u) AS mu, avg(v) AS mv, var_pop(u) AS uu, covar_pop(u, v) AS uv, var_pop(v) AS vv, covar_pop(u, u * u + v * v) AS uw, covar_pop(v, u * u + v * v) AS vw, avg(u * u + v * v) AS mw
  FROM sco SEMI JOIN bs USING (plot_id, section_id, trial) WHERE e <= 0.03 GROUP BY ALL),
ft AS (SELECT *, (uw * vv - vw * uv) / (2 * (uu * vv - uv * uv)) AS a, (vw * uu - uw * uv) / (2 * (uu * vv - uv * uv)) AS b FROM mo)"""


@query("A7_circle_fit", FIT + f" SELECT plot_id, section_id, {even('a', 5)} AS cu, {even('b', 5)} AS cv, {even('sqrt(mw - 2 * (a * mu + b * mv) + a * a + b * b)', 5)} AS radius, n_inliers FROM ft")
def _(v):
    out = sm.circle_fit(v.sections.select(*BY, "point_id", "u", "v"), BY, trials=TRIALS)
    return out.select(*BY, *[half_even(F.col(c), 5).alias(c) for c in ("cu", "cv", "radius")], "n_inliers")


RINGS = "rg AS (SELECT *, sqrt((u - 0.01) * (u - 0.01) + v * v) AS d FROM fx_sections), on_ring AS (SELECT * FROM rg WHERE d >= 0.8 * radius AND d <= 1.2 * radius)"


def circles(v):
    return v.sections.groupBy(*BY).agg(F.first("radius").alias("radius")).withColumns({"cu": F.lit(0.01), "cv": F.lit(0.0)})


@query("A8_cci", S + f""", {RINGS}, k AS (SELECT plot_id, section_id, count(DISTINCT CAST((round_even(g / 10, 0) + 36) AS INT) % 36) AS n FROM (SELECT *, degrees(atan2(v, u - 0.01)) AS g FROM on_ring) WHERE abs(g - round_even(g / 10, 0) * 10) < 5 GROUP BY ALL)
SELECT plot_id, section_id, {even('coalesce(n, 0) * 100.0::DOUBLE / 36')} AS cci FROM (SELECT DISTINCT plot_id, section_id FROM fx_sections) LEFT JOIN k USING (plot_id, section_id)""")
def _(v):
    return sm.circumferential_completeness(v.sections, circles(v), BY)


@query("A8_cci_reference", S + f""", {RINGS}, k AS (SELECT plot_id, section_id, count(DISTINCT s) AS n FROM (SELECT *, unnest(range(0, 36)) AS s FROM on_ring)
  WHERE degrees(acos(least(greatest((cos(s * 10 - 180) * (u - 0.01) + sin(s * 10 - 180) * v) / d, -1), 1))) < 5 GROUP BY ALL)
SELECT plot_id, section_id, {even('coalesce(n, 0) * 100.0::DOUBLE / 36')} AS cci FROM (SELECT DISTINCT plot_id, section_id FROM fx_sections) LEFT JOIN k USING (plot_id, section_id)""")
def _(v):
    return sm.circumferential_completeness(v.sections, circles(v), BY, mode="reference")


SMOOTH = fx("fx_cylinders").rstrip() + f""", nb AS (SELECT p.plot_id, p.tree_id, p.cyl_id, q.radius, q.x, q.y, q.nx, q.ny, q.nz, q.cci FROM fx_cylinders p JOIN fx_cylinders q ON p.plot_id = q.plot_id AND p.tree_id = q.tree_id
  QUALIFY row_number() OVER (PARTITION BY p.plot_id, p.tree_id, p.cyl_id ORDER BY {D3}, q.cyl_id) <= 7)
SELECT plot_id, tree_id, cyl_id, {', '.join(f'median({c}) AS {c}' for c in ('radius', 'x', 'y', 'nx', 'ny'))}, {even('avg(cci)', 6)} AS cci FROM nb GROUP BY plot_id, tree_id, cyl_id"""


@query("A10_smooth_knn_median", SMOOTH)
def _(v):
    out = sm.smooth_cylinders(v.cylinders)
    return out.select("plot_id", "tree_id", "cyl_id", "radius", "x", "y", "nx", "ny", half_even(F.col("cci"), 6).alias("cci"))


@query("A35_cylinder_fit_lsq")
def _(v):
    # one-metre stem pieces of every scanned tree
    pts = stems(v).withColumn("piece", F.floor("z"))
    out = sm.cylinder_fit_variation(pts.select("plot_id", "tree", "piece", "point_id", "x", "y", "z"), ("plot_id", "tree", "piece"))
    return out.select("plot_id", "tree", "piece", *[half_even(F.col(c), 5).alias(c) for c in ("radius", "x", "y", "z", "cv")], "n")
