"""Views over the driver tables in the layouts of point clouds, cylinders and tapers.

One SQL text per view serves both engines, so a Spark query and its DuckDB check
read the same rows. ``{lineitem}`` and friends are replaced by a DataFrame on Spark
and by the table name on DuckDB. Every view covers its whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

N_PLOTS = 4
D = "CAST({} AS DOUBLE)".format

VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "fx_points": (
        ("lineitem",),
        """
SELECT point_id, plot_id, x, y, z, z - (x / 20 + y / 50) AS hag, label, intensity, return_number, scan_range,
  classification, gps_time
FROM (
  SELECT l_orderkey * 64 + row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey,
      l_extendedprice, l_quantity, l_shipdate, l_discount, l_tax) AS point_id,
    CAST(l_suppkey % 4 AS INT) AS plot_id,
    (l_partkey % 400) / CAST(10 AS DOUBLE) - 20 AS x,
    (CAST(round(l_extendedprice * 100) AS BIGINT) % 4000) / CAST(100 AS DOUBLE) - 20 AS y,
    l_quantity / CAST(2 AS DOUBLE) + (l_orderkey % 50) / CAST(100 AS DOUBLE) AS z,
    CAST(1 + l_linenumber % 4 AS INT) AS label,
    CAST(l_suppkey % 100 AS INT) AS intensity,
    CAST(l_linenumber % 3 AS INT) AS return_number,
    l_quantity AS scan_range,
    CAST(CASE WHEN l_partkey % 50 = 0 THEN 7 ELSE 1 END AS INT) AS classification,
    l_orderkey / CAST(8 AS DOUBLE) AS gps_time
  FROM {lineitem}) p""",
    ),
    "fx_dtm": (
        ("part",),
        """
SELECT plot_id, gx, gy, gx * CAST(2 AS DOUBLE) - 20 AS x, gy * CAST(2 AS DOUBLE) - 20 AS y,
  (gx * CAST(2 AS DOUBLE) - 20) / 20 + (gy * CAST(2 AS DOUBLE) - 20) / 50 AS z
FROM (
  SELECT CAST(p_partkey % 4 AS INT) AS plot_id,
    CAST(CAST(floor(p_partkey / CAST(4 AS DOUBLE)) AS BIGINT) % 21 AS BIGINT) AS gx,
    CAST(floor(floor(p_partkey / CAST(4 AS DOUBLE)) / CAST(21 AS DOUBLE)) AS BIGINT) AS gy
  FROM {part}) g""",
    ),
    "fx_cylinders": (
        ("orders",),
        """
SELECT cyl_id, plot_id, tree_id, branch_id, parent_branch_id, x, y, z, nx, ny, nz, radius, cci, main_stem,
  z - (x / 20 + y / 50) AS height_above_dtm
FROM (
  SELECT o_orderkey AS cyl_id, CAST(o_orderkey % 4 AS INT) AS plot_id, o_custkey % 50 AS tree_id, o_custkey % 150 AS branch_id,
    o_custkey % 50 AS parent_branch_id,
    (o_custkey % 50) * CAST(7 AS DOUBLE) % 40 - 20 + (o_orderkey % 7) / CAST(100 AS DOUBLE) AS x,
    (o_custkey % 50) * CAST(11 AS DOUBLE) % 40 - 20 + (o_orderkey % 5) / CAST(100 AS DOUBLE) AS y,
    (o_orderkey % 250) / CAST(10 AS DOUBLE) AS z,
    (o_custkey % 5) / CAST(20 AS DOUBLE) AS nx, (o_orderkey % 3) / CAST(20 AS DOUBLE) AS ny, CAST(1 AS DOUBLE) AS nz,
    (CAST(round(o_totalprice * 100) AS BIGINT) % 300) / CAST(1000 AS DOUBLE) AS radius,
    CAST(o_custkey % 101 AS DOUBLE) AS cci,
    CAST(CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE 1 END AS INT) AS main_stem
  FROM {orders}) c""",
    ),
    "fx_taper": (
        ("lineitem",),
        """
SELECT CAST(l_orderkey % 4 AS INT) AS plot_id, l_orderkey AS tree_id,
  (5 + 3 * (l_linenumber - 1) * (l_linenumber - 1)) / CAST(10 AS DOUBLE) AS height_bin,
  max(l_quantity) / CAST(100 AS DOUBLE) AS ma_diameter, CAST(10 + l_orderkey % 20 AS DOUBLE) AS height,
  (l_orderkey % 280) / CAST(10 AS DOUBLE) - 14 + (l_orderkey * l_linenumber % 31) / CAST(100 AS DOUBLE) AS bin_x,
  (l_orderkey % 240) / CAST(10 AS DOUBLE) - 12 + (l_orderkey * l_linenumber % 37) / CAST(100 AS DOUBLE) AS bin_y,
  CAST(count(*) AS BIGINT) AS s_count, CAST(max(l_partkey % 30) AS BIGINT) AS ns_count,
  CAST(max(l_suppkey % 101) AS DOUBLE) AS cci
FROM {lineitem} GROUP BY l_orderkey, l_linenumber""",
    ),
    "fx_field_trees": (
        ("customer",),
        """
SELECT CAST(c_custkey % 4 AS INT) AS plot_id, c_custkey AS tree_id,
  CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_custkey + 7 END AS field_id,
  (c_custkey * 37 % 1400) / CAST(100 AS DOUBLE) AS distance, CAST(c_custkey * 53 % 360 AS DOUBLE) AS bearing,
  CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE (500 + c_custkey * 17 % 3000) / CAST(10 AS DOUBLE) END AS dbh_mm,
  CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE CAST(5 + c_custkey % 25 AS DOUBLE) END AS height,
  CAST(4 + c_custkey % 25 AS DOUBLE) AS prev_height,
  CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE CAST(c_custkey % 101 AS DOUBLE) END AS cci
FROM {customer}""",
    ),
    "fx_segments": (
        ("customer",),
        """
SELECT c_custkey AS branch_id, CAST(floor(c_custkey / CAST(2 AS DOUBLE)) AS BIGINT) AS parent_branch_id,
  CAST(0 AS INT) AS plot_id, (20 + c_custkey * 13 % 180) / CAST(1000 AS DOUBLE) AS mean_radius,
  (c_custkey * 7 % 97) / CAST(10 AS DOUBLE) AS z_min
FROM {customer}""",
    ),
    "fx_gps": (
        ("events",),
        """
SELECT event_id, CAST(event_id % 4 AS INT) AS plot_id, ts + {days} AS utc FROM {events}""",
    ),
    "fx_votes": (
        ("embeddings",),
        """
SELECT vec_id AS vote_id, CAST(vec_id % 4 AS INT) AS plot_id,
  CAST({e}embedding{o}1{c} AS DOUBLE) * 60 AS x, CAST({e}embedding{o}2{c} AS DOUBLE) * 60 AS y,
  13 + CAST({e}embedding{o}3{c} AS DOUBLE) * 40 AS z,
  abs(CAST({e}embedding{o}4{c} AS DOUBLE)) AS p0, abs(CAST({e}embedding{o}5{c} AS DOUBLE)) AS p1,
  abs(CAST({e}embedding{o}6{c} AS DOUBLE)) AS p2, abs(CAST({e}embedding{o}7{c} AS DOUBLE)) AS p3
FROM {embeddings}""",
    ),
    # plot 4 has no trees and no points: it must still get a summary row
    "fx_plots": (
        ("supplier",),
        """
SELECT plot_id, plot_id / CAST(10 AS DOUBLE) AS cx, plot_id / CAST(20 AS DOUBLE) AS cy,
  CAST(14 + plot_id AS DOUBLE) AS plot_radius, CAST(2 AS DOUBLE) AS plot_radius_buffer, n_sources
FROM (SELECT CAST(s_suppkey % 5 AS INT) AS plot_id, count(*) AS n_sources FROM {supplier} GROUP BY s_suppkey % 5) s""",
    ),
    # a scanned plantation: twelve tapering stems per plot, crowns, and sloping ground
    "fx_scan": (
        ("lineitem",),
        """
SELECT point_id, plot_id, tree, label, floor(x * 1000 + 0.5) / CAST(1000 AS DOUBLE) AS x, floor(y * 1000 + 0.5) / CAST(1000 AS DOUBLE) AS y,
  floor(z * 1000 + 0.5) / CAST(1000 AS DOUBLE) AS z, intensity, gps_time
FROM (
  SELECT point_id, plot_id, tree, label, intensity, gps_time,
    CASE WHEN label = 1 THEN h * 20 - 10 ELSE tx + CASE WHEN label = 4 THEN lean * h * 9 + r * cos(radians(a)) ELSE crown * cos(radians(a)) END END AS x,
    CASE WHEN label = 1 THEN a / 18 - 10 ELSE ty + CASE WHEN label = 4 THEN r * sin(radians(a)) ELSE crown * sin(radians(a)) END END AS y,
    CASE WHEN label = 1 THEN (h * 20 - 10) / 20 WHEN label = 4 THEN tx / 20 + h * 9 ELSE tx / 20 + 7 + h * 5 END AS z
  FROM (
    SELECT *, (tree % 4) * CAST(5 AS DOUBLE) - CAST(15 AS DOUBLE) / 2 AS tx, floor(tree / CAST(4 AS DOUBLE)) * 5 - 5 AS ty,
      (tree % 3) / CAST(50 AS DOUBLE) AS lean, CAST(16 AS DOUBLE) / 100 - h * 8 / 100 + e AS r
    FROM (
      SELECT l_orderkey * 64 + row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice,
          l_quantity, l_shipdate, l_discount, l_tax) AS point_id,
        CAST(l_suppkey % 4 AS INT) AS plot_id, CAST(floor(l_suppkey % 48 / CAST(4 AS DOUBLE)) AS INT) AS tree,
        CAST(CASE WHEN (l_partkey + l_orderkey) % 8 < 2 THEN 1 WHEN (l_partkey + l_orderkey) % 8 = 2 THEN 2 ELSE 4 END AS INT) AS label,
        ((l_orderkey * 7919 + l_partkey * 104729) % 10007) / CAST(10007 AS DOUBLE) AS h,
        ((l_partkey * 7907 + l_orderkey * 3571 + l_suppkey * 17) % 3600) / CAST(10 AS DOUBLE) AS a,
        ((l_partkey * 31 + l_orderkey * 17) % 21 - 10) / CAST(2000 AS DOUBLE) AS e,
        l_quantity * 3 / CAST(100 AS DOUBLE) AS crown, CAST(l_suppkey % 100 AS INT) AS intensity, l_orderkey / CAST(8 AS DOUBLE) AS gps_time
      FROM {lineitem}) b) c) d""",
    ),
    # noisy circle sections: 40 points each, every ninth off the stem
    "fx_sections": (
        ("customer",),
        """
SELECT plot_id, section_id, point_id, cos(radians(point_id * 9)) * d AS u, sin(radians(point_id * 9)) * d AS v, radius
FROM (
  SELECT plot_id, section_id, point_id, radius,
    CASE WHEN point_id % 9 = 0 THEN radius * 8 / 5 ELSE radius + ((section_id * 31 + point_id * point_id * 7) % 11 - 5) / CAST(1000 AS DOUBLE) END AS d
  FROM (SELECT CAST(c_custkey % 4 AS INT) AS plot_id, c_custkey AS section_id, (50 + c_custkey * 17 % 200) / CAST(1000 AS DOUBLE) AS radius,
    explode(sequence(0L, CAST(39 - c_custkey % 20 AS BIGINT))) AS point_id FROM {customer}) s) t""",
    ),
    "fx_diameters": (
        ("orders",),
        """
SELECT o_orderkey AS row_id, o_custkey AS tree_id,
  CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE (50 + o_orderkey % 400) / CAST(1000 AS DOUBLE) END AS ma_diameter,
  CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE CAST(10 + o_custkey % 20 AS DOUBLE) END AS tree_height
FROM {orders}""",
    ),
    "fx_survey": (
        ("customer",),
        """
SELECT c_custkey AS plot_id, CAST(100 + c_custkey % 200 AS DOUBLE) AS mindbh, CAST(300 + c_custkey % 500 AS DOUBLE) AS maxdbh,
  CAST(8 + c_custkey % 25 AS DOUBLE) AS tree_height, CAST(1 + c_custkey % 3 AS DOUBLE) / 2 AS ground_veg_cutoff_height
FROM {customer}""",
    ),
    "fx_vr": (
        ("orders",),
        """
SELECT line_no, CAST(floor(line_no / CAST(3 AS DOUBLE)) AS BIGINT) % 4 AS plot_id, line_no % 3 AS line_in_tree,
  (line_no * 7 % 300) / CAST(10 AS DOUBLE) AS position, (line_no * 11 % 400) / CAST(10 AS DOUBLE) - 20 AS x,
  (line_no * 13 % 400) / CAST(10 AS DOUBLE) - 20 AS y, (line_no * 17 % 140) / CAST(10 AS DOUBLE) AS distance,
  CAST(line_no * 19 % 360 AS DOUBLE) AS bearing, CAST(100 + line_no * 23 % 400 AS DOUBLE) AS diameter
FROM (SELECT o_orderkey AS line_no FROM {orders}) l""",
    ),
}

_SPARK_PARTS = {"e": "element_at(", "o": ",", "c": ")", "days": "make_dt_interval(CAST(event_id % 400 AS INT))"}
_DUCK_PARTS = {"e": "", "o": "[", "c": "]", "days": "to_days(CAST(event_id % 400 AS INT))"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows of a table per task where a view makes many rows of each.
SPREAD_ROWS = 20_000


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    tables, text = VIEWS[name]
    for key, value in _SPARK_PARTS.items():
        text = text.replace("{" + key + "}", value)
    rows = {t: table(spark, sf_dir, t) for t in tables}
    if "explode(" in text:
        # a small file is one task, whatever its rows become
        rows = {t: df.repartition(1 + df.count() // SPREAD_ROWS, df.columns[0]) for t, df in rows.items()}
    return spark.sql(text, **rows)


def duck_ctes(*names: str) -> str:
    """``WITH`` head that defines the named views for DuckDB."""
    parts = []
    for name in names:
        tables, text = VIEWS[name]
        text = text.replace("explode(sequence(0L, CAST(39 - c_custkey % 20 AS BIGINT)))", "unnest(range(0, 40 - c_custkey % 20))")
        for key, value in {**_DUCK_PARTS, **{t: t for t in tables}}.items():
            text = text.replace("{" + key + "}", value)
        parts.append(f"{name} AS ({text})")
    return "WITH " + ",\n".join(parts)
