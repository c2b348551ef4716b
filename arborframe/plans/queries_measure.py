"""Taper, diameter, volume, numbering and report queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from arborframe.functions import forestry as forest
from arborframe.functions.numeric import half_even
from arborframe.operators import measure as me
from arborframe.operators import report as rp
from arborframe.plans.registry import query
from arborframe.plans.sqltext import even, fx

DBH = 1.7
FRUSTUM = "pi() / 12 * (h2 - height_bin) * (d * d + d2 * d2 + d * d2)"


def volume_ctes(name: str, source: str, diameter: str) -> str:
    return f"""
{name}_n AS (SELECT plot_id, tree_id, height_bin, height, {diameter} AS d,
    lead({diameter}) OVER (PARTITION BY plot_id, tree_id ORDER BY height_bin) AS d2,
    lead(height_bin) OVER (PARTITION BY plot_id, tree_id ORDER BY height_bin) AS h2,
    row_number() OVER (PARTITION BY plot_id, tree_id ORDER BY abs(height_bin - {DBH}), height_bin) AS near,
    row_number() OVER (PARTITION BY plot_id, tree_id ORDER BY height_bin) AS lo,
    row_number() OVER (PARTITION BY plot_id, tree_id ORDER BY height_bin DESC) AS hi FROM {source}),
{name} AS (SELECT plot_id, tree_id,
    coalesce(sum({FRUSTUM}), 0) + max(CASE WHEN hi = 1 THEN (height - height_bin) * pi() * d * d / 12 END)
      + max(CASE WHEN lo = 1 THEN pi() * d * d / 4 * (height_bin - 0.3) END) AS volume_1,
    max(CASE WHEN near = 1 THEN pi() * d * d / 4 * ((height - height_bin) / 3 + height_bin) END) AS volume_2,
    max(CASE WHEN near = 1 THEN height_bin END) AS dbh_bin, max(CASE WHEN near = 1 THEN d END) AS dbh
  FROM {name}_n GROUP BY plot_id, tree_id)"""


Z = f"((height - {DBH}) / height)"
DUB = "({d} * sqrt(0.7016 + 0.5646 * {z} - 0.6188 * {z} * {z}))"
TREES = (
    fx("fx_taper", "fx_plots").rstrip()
    + ","
    + volume_ctes("vol", "fx_taper", "ma_diameter")
    + f",\nunder AS (SELECT *, {DUB.format(d='ma_diameter', z=Z)} AS dub FROM fx_taper),"
    + volume_ctes("vub", "under", "dub")
    + f""",
trees AS (SELECT t.plot_id, t.tree_id, {even('t.bin_x', 3)} AS tree_x, {even('t.bin_y', 3)} AS tree_y,
    {even('sqrt((bin_x - cx) * (bin_x - cx) + (bin_y - cy) * (bin_y - cy))', 2)} AS distance,
    (({even('degrees(atan2(bin_x - cx, bin_y - cy))')} % 360) + 360) % 360 AS bearing,
    {even('t.height', 2)} AS height, {even('t.ma_diameter * 1000')} AS dbh_taper, {even('t.height_bin', 1)} AS dbh_bin,
    {even('t.cci')} AS cci, {even('vol.volume_1', 3)} AS volume, {even('vol.volume_2', 3)} AS volume_2,
    {even(DUB.format(d='t.ma_diameter', z=Z.replace('height', 't.height')) + ' * 1000.0')} AS dub, {even('vub.volume_1', 3)} AS vub
  FROM (SELECT *, row_number() OVER (PARTITION BY plot_id, tree_id ORDER BY abs(height_bin - {DBH}), height_bin) AS r FROM fx_taper) t
  JOIN vol USING (plot_id, tree_id) JOIN vub USING (plot_id, tree_id) JOIN fx_plots USING (plot_id)
  WHERE r = 1 AND ma_diameter >= 0.1)
"""
)
AREA = even("pi() * plot_radius * plot_radius / 10000", 3)


def tree_frame(v):
    return me.tree_table(v.taper, v.plots, DBH, 0.1)


def plot_frame(v):
    return v.plots.withColumn("area_ha", half_even(F.pi() * F.col("plot_radius") * F.col("plot_radius") / 10000.0, 3))


STATS = [("dbh_taper", "dbh"), ("height", "height"), ("volume", "volume")]
STAT_SQL = ", ".join(
    f"{even(f'coalesce(avg({c}), 0)', 4)} AS mean_{n}, coalesce(median({c}), 0) AS median_{n}, coalesce(min({c}), 0) AS min_{n}, coalesce(max({c}), 0) AS max_{n}"
    for c, n in STATS
)
PLOT_STATS = (
    TREES
    + f""", stats AS (SELECT p.plot_id, {AREA} AS area_ha, count(tree_id) AS n_trees, {STAT_SQL},
    {even('coalesce(sum(volume), 0)', 4)} AS total_volume, {even(f'count(tree_id) / {AREA}', 1)} AS stems_per_ha
  FROM fx_plots p LEFT JOIN trees t ON p.plot_id = t.plot_id GROUP BY p.plot_id, plot_radius)
"""
)


def stats_frame(v):
    out = rp.plot_stats(tree_frame(v), plot_frame(v))
    for c in ("mean_dbh", "mean_height", "mean_volume", "total_volume"):
        out = out.withColumn(c, half_even(F.col(c), 4))
    return out


@query("tree_data", TREES + "SELECT * FROM trees")
def _(v):
    return tree_frame(v)


@query("A20_plot_stats", PLOT_STATS + "SELECT * FROM stats")
def _(v):
    return stats_frame(v)


@query("A15_taper_summary", fx("fx_taper") + """SELECT * EXCLUDE (r) FROM (SELECT *, row_number() OVER (PARTITION BY plot_id, tree_id ORDER BY height_bin DESC) AS r FROM fx_taper) WHERE r = 1""")
def _(v):
    return me.taper_summary(v.taper)


@query("A19_dbh_row", fx("fx_taper") + f"""SELECT plot_id, tree_id, height_bin, ma_diameter FROM (SELECT *,
  row_number() OVER (PARTITION BY plot_id, tree_id ORDER BY abs(height_bin - {DBH}), height_bin) AS r FROM fx_taper) WHERE r = 1 AND ma_diameter >= 0.1""")
def _(v):
    return me.dbh_rows(v.taper, DBH, 0.1).select("plot_id", "tree_id", "height_bin", "ma_diameter")


@query("A19_crown_height", fx("fx_taper") + """SELECT plot_id, tree_id,
  coalesce(max(CASE WHEN s_count > ns_count / 10.0 THEN height_bin END), 0) AS crown_height FROM fx_taper GROUP BY plot_id, tree_id""")
def _(v):
    return me.crown_height(v.taper)


@query("W3_frustum_volume", fx("fx_taper").rstrip() + "," + volume_ctes("vol", "fx_taper", "ma_diameter") + f" SELECT plot_id, tree_id, {even('volume_1', 6)} AS volume_1 FROM vol")
def _(v):
    return me.volumes(v.taper, DBH).select("plot_id", "tree_id", half_even(F.col("volume_1"), 6).alias("volume_1"))


@query("W4_cone_volume", fx("fx_taper").rstrip() + "," + volume_ctes("vol", "fx_taper", "ma_diameter") + f" SELECT plot_id, tree_id, dbh_bin, {even('volume_2', 6)} AS volume_2 FROM vol")
def _(v):
    return me.volumes(v.taper, DBH).select("plot_id", "tree_id", "dbh_bin", half_even(F.col("volume_2"), 6).alias("volume_2"))


@query("W5_vub", fx("fx_taper").rstrip() + f", under AS (SELECT *, {DUB.format(d='ma_diameter', z=Z)} AS dub FROM fx_taper)," + volume_ctes("vub", "under", "dub") + f" SELECT plot_id, tree_id, {even('volume_1', 6)} AS vub FROM vub")
def _(v):
    return me.volumes(me.under_bark_taper(v.taper, DBH), DBH, "dub").select("plot_id", "tree_id", half_even(F.col("volume_1"), 6).alias("vub"))


@query("W6_number_by_bearing", TREES + """SELECT plot_id, tree_id, CASE WHEN dbh_taper >= 250 THEN row_number() OVER (PARTITION BY plot_id, dbh_taper >= 250 ORDER BY bearing, tree_id) ELSE -1 END AS tree_number FROM trees""")
def _(v):
    return me.number_by_bearing(tree_frame(v), F.col("dbh_taper") >= 250).select("plot_id", "tree_id", "tree_number")


@query("W7_renumber", fx("fx_field_trees") + "SELECT plot_id, tree_id, bearing, row_number() OVER (PARTITION BY plot_id ORDER BY bearing, tree_id) AS new_id FROM fx_field_trees")
def _(v):
    return me.ranked_by_bearing(v.field_trees, "new_id").select("plot_id", "tree_id", "bearing", "new_id")


@query("M5_dub", fx("fx_taper") + f"SELECT plot_id, tree_id, height_bin, {even(DUB.format(d='ma_diameter', z=Z), 6)} AS dub FROM fx_taper")
def _(v):
    return me.under_bark_taper(v.taper, DBH).select("plot_id", "tree_id", "height_bin", half_even(F.col("dub"), 6).alias("dub"))


@query("M13_mm_cm_units", fx("fx_taper", "fx_diameters") + f"SELECT row_id, {even('ma_diameter * 1000')} AS mm_from_m, ma_diameter * 100 * 10 AS mm_from_cm FROM fx_diameters")
def _(v):
    d = F.col("ma_diameter")
    return v.diameters.select("row_id", forest.metres_to_mm(d).alias("mm_from_m"), forest.cm_to_mm(d * 100.0).alias("mm_from_cm"))


@query("M14_qc_cone_volume", fx("fx_field_trees") + f"""SELECT plot_id, tree_id, {even('pi() * (dbh_mm / 1000) * (dbh_mm / 1000) / 4 * ((height - 1.4) / 3 + 1.4)', 2)} AS volume_cone FROM fx_field_trees""")
def _(v):
    return v.field_trees.select("plot_id", "tree_id", forest.qc_cone_volume(F.col("dbh_mm"), F.col("height"), F.lit(1.4)).alias("volume_cone"))
