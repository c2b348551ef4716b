"""Point-to-tree assignment and per-tree measures."""

from __future__ import annotations

from pyspark.sql import functions as F

from arborframe.functions.numeric import half_even
from arborframe.operators import measure as me
from arborframe.plans.registry import query
from arborframe.plans.sqltext import even, fx

PC = fx("fx_points", "fx_cylinders").rstrip()
P = fx("fx_points").rstrip()
D3 = "sqrt((p.x - c.x) * (p.x - c.x) + (p.y - c.y) * (p.y - c.y) + (p.z - c.z) * (p.z - c.z))"
D2 = "sqrt((p.x - c.x) * (p.x - c.x) + (p.y - c.y) * (p.y - c.y))"


def nearest_sql(name: str, points: str, cyls: str, radius: float, flat: bool) -> str:
    """Cylinders are copied to the cells around theirs, so the join is on plot and cell."""
    d = D2 if flat else D3
    near = f"SELECT *, floor(x / {radius}) + dx AS cx, floor(y / {radius}) + dy AS cy FROM {cyls}, (SELECT unnest([-1, 0, 1]) AS dx), (SELECT unnest([-1, 0, 1]) AS dy)"
    cells = f"p.plot_id = c.plot_id AND floor(p.x / {radius}) = c.cx AND floor(p.y / {radius}) = c.cy"
    return f"""{name}_c AS (SELECT p.plot_id, p.point_id, c.tree_id, {d} AS d, c.cyl_id FROM {points} p JOIN ({near}) c ON {cells} AND {d} <= {radius}),
{name} AS (SELECT plot_id, point_id, tree_id FROM {name}_c QUALIFY row_number() OVER (PARTITION BY point_id ORDER BY d, cyl_id) = 1)"""


STEMS = "stems AS (SELECT * FROM fx_points WHERE label = 4)"
VEG = "veg AS (SELECT * FROM fx_points WHERE label = 2)"


def stems(v):
    return v.points.filter("label = 4")


def veg(v):
    return v.points.filter("label = 2")


@query("J6_assign_stem_3d", PC + f", {STEMS}, " + nearest_sql("a", "stems", "fx_cylinders", 1.2, False) + " SELECT plot_id, point_id, tree_id FROM a")
def _(v):
    return me.assign_points(stems(v), v.cylinders, 1.2)[0].select("plot_id", "point_id", "tree_id")


@query("J7_assign_veg_3d", PC + f", {VEG}, " + nearest_sql("a", "veg", "fx_cylinders", 2.5, False) + " SELECT plot_id, point_id, tree_id FROM a")
def _(v):
    return me.assign_points(veg(v), v.cylinders, 2.5)[0].select("plot_id", "point_id", "tree_id")


def level_sql(name: str, share: float) -> str:
    return f"{name} AS (SELECT plot_id, list_sort(list(z))[CAST(floor(count(*) * CAST({share} AS DOUBLE)) AS INT) + 1] AS t FROM fx_cylinders GROUP BY plot_id)"


@query("J8_assign_stem_2d", PC + f", {STEMS}, {level_sql('mid', 0.5)}, upper_c AS (SELECT c.* FROM fx_cylinders c JOIN mid USING (plot_id) WHERE z > t), "
       + nearest_sql("a", "stems", "upper_c", 1.2, True) + " SELECT plot_id, point_id, tree_id FROM a")
def _(v):
    return me.assign_stem_2d(stems(v), v.cylinders, 1.2)[0].select("plot_id", "point_id", "tree_id")


# with min_left = 0 every plot runs all passes
LEVELS = PC + f""", {VEG}, {level_sql('t90', 0.9)}, {level_sql('t80', 0.8)}, {level_sql('t70', 0.7)},
b1 AS (SELECT c.* FROM fx_cylinders c JOIN t90 USING (plot_id) WHERE z > t90.t),
b2 AS (SELECT c.* FROM fx_cylinders c JOIN t90 USING (plot_id) JOIN t80 USING (plot_id) WHERE z <= t90.t AND z > t80.t),
b3 AS (SELECT c.* FROM fx_cylinders c JOIN t80 USING (plot_id) JOIN t70 USING (plot_id) WHERE z <= t80.t AND z > t70.t),
b4 AS (SELECT c.* FROM fx_cylinders c JOIN t70 USING (plot_id) WHERE z < t70.t),
{nearest_sql('a1', 'veg', 'b1', 2.5, True)}, r1 AS (SELECT * FROM veg ANTI JOIN a1 USING (point_id)),
{nearest_sql('a2', 'r1', 'b2', 2.0, True)}, r2 AS (SELECT * FROM r1 ANTI JOIN a2 USING (point_id)),
{nearest_sql('a3', 'r2', 'b3', 1.5, True)}, r3 AS (SELECT * FROM r2 ANTI JOIN a3 USING (point_id)),
{nearest_sql('a4', 'r3', 'b4', 2.5, True)}
SELECT * FROM a1 UNION ALL SELECT * FROM a2 UNION ALL SELECT * FROM a3 UNION ALL SELECT * FROM a4"""


@query("J9_assign_veg_levels", LEVELS)
def _(v):
    return me.assign_veg_levels(veg(v), v.cylinders, 2.5, min_left=0)[0].select("plot_id", "point_id", "tree_id")


VOTE = fx("fx_points", "fx_votes").rstrip() + f""", near AS (SELECT p.plot_id, p.point_id, c.p0, c.p1, c.p2, c.p3 FROM fx_points p JOIN fx_votes c ON p.plot_id = c.plot_id
  QUALIFY row_number() OVER (PARTITION BY point_id ORDER BY {D3}, vote_id) <= 5),
m AS (SELECT plot_id, point_id, median(p0) AS a, median(p1) AS b, median(p2) AS c, median(p3) AS d FROM near GROUP BY plot_id, point_id)
SELECT plot_id, point_id, CAST(CASE greatest(a, b, c, d) WHEN a THEN 0 WHEN b THEN 1 WHEN c THEN 2 ELSE 3 END AS INT) AS label FROM m"""


@query("J1_label_vote", VOTE)
def _(v):
    return me.label_vote(v.points, v.votes, 5)


EXP = "exp(p0 - g) + exp(p1 - g) + exp(p2 - g) + exp(p3 - g)"


@query("A36_votes_to_class", fx("fx_votes") + f"""SELECT vote_id, {', '.join(even(f'exp(p{i} - g) / ({EXP})', 9) + f' AS q{i}' for i in range(4))},
CAST(CASE g WHEN p0 THEN 0 WHEN p1 THEN 1 WHEN p2 THEN 2 ELSE 3 END AS INT) AS class FROM (SELECT *, greatest(p0, p1, p2, p3) AS g FROM fx_votes)""")
def _(v):
    out = me.votes_to_class(v.votes, ["p0", "p1", "p2", "p3"])
    return out.select("vote_id", *[half_even(F.element_at("p", i + 1), 9).alias(f"q{i}") for i in range(4)], "class")


# tree ids for point-level measures come from the point's own columns
TREED = "treed AS (SELECT *, CAST(intensity % 50 AS BIGINT) AS tree_id FROM fx_points WHERE label IN (2, 4))"


def treed(v):
    return v.points.filter("label IN (2, 4)").withColumn("tree_id", (F.col("intensity") % 50).cast("long"))


@query("A16_tree_height", P + f", {TREED}, h AS (SELECT plot_id, tree_id, max(hag) AS h FROM treed GROUP BY ALL)"
       f" SELECT plot_id, tree_id, {even('h', 2)} AS height, {', '.join(even(c, 3) + f' AS crown_top_{c}' for c in 'xyz')} FROM (SELECT *, row_number() OVER (PARTITION BY plot_id, tree_id ORDER BY z DESC, point_id) AS r FROM treed) JOIN h USING (plot_id, tree_id) WHERE r = 1")
def _(v):
    return me.tree_height(treed(v))


@query("A17_crown_mean", P + f", {TREED} SELECT plot_id, tree_id, {even('avg(x) FILTER (label = 2)', 3)} AS crown_mean_x, {even('avg(y) FILTER (label = 2)', 3)} AS crown_mean_y FROM treed GROUP BY plot_id, tree_id")
def _(v):
    return me.crown_mean(treed(v))


BASE = f""", {TREED}, sp AS (SELECT *, min(hag) OVER (PARTITION BY plot_id, tree_id) AS low FROM treed WHERE label = 4),
n1 AS (SELECT plot_id, tree_id, count(*) FILTER (hag - low < 0.01) AS n FROM sp GROUP BY ALL),
bz AS (SELECT plot_id, tree_id, z - hag AS base_z FROM sp JOIN n1 USING (plot_id, tree_id) WHERE hag - low < CASE WHEN n < 3 THEN 0.04 ELSE 0.01 END
  QUALIFY row_number() OVER (PARTITION BY plot_id, tree_id ORDER BY z DESC, point_id) = 1),
bxy AS (SELECT plot_id, tree_id, x AS base_x, y AS base_y FROM fx_cylinders QUALIFY row_number() OVER (PARTITION BY plot_id, tree_id ORDER BY height_above_dtm, cyl_id) = 1),
base AS (SELECT * FROM bxy JOIN bz USING (plot_id, tree_id))"""


def base(v):
    return me.tree_base(treed(v).filter("label = 4"), v.cylinders, 3)


@query("A18_tree_base", PC + BASE + f" SELECT plot_id, tree_id, base_x, base_y, {even('base_z', 6)} AS base_z FROM base")
def _(v):
    return base(v).withColumn("base_z", half_even(F.col("base_z"), 6))


Z0 = "base_z + height_bin"
TAPER = BASE + f""", top AS (SELECT plot_id, least(max(height_above_dtm), 50) AS t FROM fx_cylinders GROUP BY plot_id),
bins AS (SELECT plot_id, tree_id, base_z, (CAST(5 AS DOUBLE) + k * CAST(1 AS DOUBLE)) / CAST(10 AS DOUBLE) AS height_bin FROM (
  SELECT plot_id, tree_id, base_z, unnest(range(0, CAST(ceil((t * 10 - 5) / 1) AS BIGINT))) AS k FROM base JOIN top USING (plot_id))),
disc AS (SELECT b.plot_id, b.tree_id, height_bin, {even(even('avg(radius) * 2', 9), 3)} AS ma_diameter, {even(even('avg(cci)', 9))} AS cci, {even(even('avg(x)', 9), 3)} AS bin_x, {even(even('avg(y)', 9), 3)} AS bin_y
  FROM bins b JOIN fx_cylinders c ON b.plot_id = c.plot_id AND b.tree_id = c.tree_id AND main_stem > 0 AND radius > 0 AND z >= {Z0} - 0.3 AND z <= {Z0} + 0.3 GROUP BY ALL),
cnt AS (SELECT b.plot_id, b.tree_id, height_bin, count(*) FILTER (label = 4) AS s, count(*) FILTER (label = 2) AS ns
  FROM bins b JOIN treed p ON b.plot_id = p.plot_id AND b.tree_id = p.tree_id AND z >= {Z0} - 0.15 AND z <= {Z0} + 0.15 GROUP BY ALL),
tap AS (SELECT plot_id, tree_id, height_bin, ma_diameter, bin_x, bin_y, coalesce(s, 0) AS s_count, coalesce(ns, 0) AS ns_count, CAST(coalesce(s, 0) > coalesce(ns, 0) / CAST(10 AS DOUBLE) AS INT) AS pruned, cci
  FROM disc LEFT JOIN cnt USING (plot_id, tree_id, height_bin))"""


def taper_rows(v):
    return me.taper(v.cylinders, treed(v), base(v))


@query("A14_taper", PC + TAPER + " SELECT * FROM tap")
def _(v):
    return taper_rows(v)


@query("F20_dbh_fit_points", PC + TAPER + """, rk AS (SELECT *, row_number() OVER (PARTITION BY plot_id, tree_id ORDER BY height_bin) AS r FROM tap),
best AS (SELECT plot_id, tree_id, CASE WHEN bool_or(abs(height_bin - 1.3) < 0.15) THEN 1.3 ELSE arg_max(height_bin, cci * 10 - r) FILTER (r <= 2) END AS h FROM rk GROUP BY ALL),
near AS (SELECT p.*, abs(hag - h) AS gap FROM treed p JOIN best USING (plot_id, tree_id) WHERE label = 4),
n AS (SELECT plot_id, tree_id, count(*) FILTER (gap < 0.05) AS n FROM near GROUP BY ALL)
SELECT plot_id, tree_id, point_id FROM near JOIN n USING (plot_id, tree_id) WHERE gap < CASE WHEN n < 3 THEN 0.1 ELSE 0.05 END""")
def _(v):
    return me.dbh_fit_points(treed(v).filter("label = 4"), taper_rows(v), 1.3, 3).select("plot_id", "tree_id", "point_id")
