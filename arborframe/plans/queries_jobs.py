"""Whole-job queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from arborframe import params as pa
from arborframe.functions.numeric import half_even
from arborframe.plans import jobs
from arborframe.plans.queries_assemble import stacked
from arborframe.plans.queries_tiling import ASSIGN
from arborframe.plans.registry import query
from arborframe.plans.sqltext import even, fx, hash_sql

# limits for the sparse scan of the fixture
SPARSE = {
    **pa.parameters("mobile"), "eps": 0.15, "min_samples": 4, "min_cluster_size": 10, "gap_connect": 0.3, "slice_increment": 0.2,
    "slice_thickness": 0.3, "single_increment_height": 4.0, "min_points_per_box": 100, "max_points_per_box": 500, "sor_filter": 0,
    "dbh_height": 1.3, "tree_stem_min_height": 3.0, "minimum_cci": 10.0,
}


def scan_plots(v):
    return v.plots.select("plot_id", F.lit(0.0).alias("cx"), F.lit(0.0).alias("cy"), F.lit(12.0).alias("plot_radius"), F.lit(2.0).alias("plot_radius_buffer"))


def scan_ground(v):
    """Terrain nodes on half metres under the scan: z = x / 20."""
    plots = v.plots.select("plot_id")
    out = plots
    for c in ("x", "y"):
        out = out.withColumn(f"g{c}", F.explode(F.sequence(F.lit(-26), F.lit(26))))
    return out.select("plot_id", "gx", "gy", (F.col("gx") / 2.0).alias("x"), (F.col("gy") / 2.0).alias("y"), (F.col("gx") / 40.0).alias("z"))


def scan_cylinders(v):
    """True stem cylinders of the scan every 20 cm."""
    rows = v.scan.filter("label = 4").withColumn("k", F.floor(F.col("z") * 5))
    tx = (F.col("tree") % 4) * 5.0 - 7.5
    out = rows.groupBy("plot_id", "tree", "k").agg(F.min("point_id").alias("cyl_id"), *[F.avg(c).alias(c) for c in "xyz"])
    out = out.withColumn("height_above_dtm", F.col("z") - tx / 20.0)
    return out.select(
        "plot_id", "cyl_id", "x", "y", "z", F.lit(0.0).alias("nx"), F.lit(0.0).alias("ny"), F.lit(1.0).alias("nz"),
        (0.16 - F.col("height_above_dtm") / 9.0 * 0.08).alias("radius"), F.lit(90.0).alias("cci"),
        F.col("tree").cast("long").alias("tree_id"), "height_above_dtm", F.lit(1).alias("main_stem"),
    )


@query("K1_preprocess", fx("fx_scan", "fx_plots").rstrip() + """, crop AS (SELECT s.* FROM fx_scan s WHERE sqrt(x * x + y * y) < 14), kept AS (SELECT * FROM crop WHERE intensity >= 10),
dd AS (SELECT plot_id, count(*) AS n FROM (SELECT DISTINCT plot_id, x, y, z FROM kept) GROUP BY plot_id), oo AS (SELECT plot_id, count(*) AS n FROM crop GROUP BY plot_id)
SELECT p.plot_id, coalesce(oo.n, 0) AS num_points_original, coalesce(dd.n, 0) AS num_points_trimmed, coalesce(dd.n, 0) AS num_points_subsampled FROM fx_plots p LEFT JOIN oo ON oo.plot_id = p.plot_id LEFT JOIN dd ON dd.plot_id = p.plot_id""")
def _(v):
    return jobs.preprocess(v.scan, scan_plots(v), SPARSE)["summary"].select("plot_id", "num_points_original", "num_points_trimmed", "num_points_subsampled")


# the cloud as K1 leaves it, under the name the box text reads
BOXED = fx("fx_scan", "fx_plots").rstrip() + f""", ids AS (SELECT min(point_id) AS point_id FROM fx_scan WHERE sqrt(x * x + y * y) < 14 AND intensity >= 10 GROUP BY plot_id, {', '.join(even(c, 3) for c in 'xyz')}),
fx_points AS (SELECT s.* FROM fx_scan s JOIN ids USING (point_id))""" + ASSIGN
LIMITED = BOXED + f""", big AS (SELECT b.*, row_number() OVER (PARTITION BY plot_id, box_id ORDER BY {hash_sql('point_id', 1)}, point_id) AS r FROM boxed b JOIN (SELECT plot_id, box_id FROM boxed GROUP BY ALL HAVING count(*) > 100) USING (plot_id, box_id))"""


@query("K1_preprocess_samples", BOXED + " SELECT plot_id, point_id, x, y, z, box_id FROM boxed")
def _(v):
    return jobs.preprocess(v.scan, scan_plots(v), SPARSE)["samples"]


@query("K1_training_samples", LIMITED + " SELECT plot_id, point_id, x, y, z, box_id FROM big WHERE r <= 500")
def _(v):
    return jobs.preprocess(v.scan, scan_plots(v), SPARSE, limit_boxes=True)["samples"]


@query("K1_sample_counts", LIMITED + """, a AS (SELECT plot_id, count(*) AS n FROM boxed GROUP BY plot_id), k AS (SELECT plot_id, count(*) AS n FROM big WHERE r <= 500 GROUP BY plot_id)
SELECT p.plot_id, coalesce(a.n, 0) AS num_sample_rows, coalesce(k.n, 0) AS num_sample_rows_kept, coalesce(a.n, 0) - coalesce(k.n, 0) AS num_sample_rows_dropped
FROM fx_plots p LEFT JOIN a ON a.plot_id = p.plot_id LEFT JOIN k ON k.plot_id = p.plot_id""")
def _(v):
    summary = jobs.preprocess(v.scan, scan_plots(v), SPARSE, limit_boxes=True)["summary"]
    return summary.select("plot_id", "num_sample_rows", "num_sample_rows_kept", "num_sample_rows_dropped")


def scored(v):
    """Scores as a model gives them: the true class likely, the others not."""
    p = [F.when(F.col("label") == i + 1, 0.7).otherwise(0.1).alias(f"p{i}") for i in range(4)]
    return v.scan.select("plot_id", F.col("point_id").alias("vote_id"), "x", "y", "z", *p)


@query("K2_postprocess")
def _(v):
    out = jobs.postprocess(v.scan.drop("label"), scored(v), scan_plots(v), SPARSE)
    return out["points"].groupBy("plot_id", "label", "height_class").agg(F.count(F.lit(1)).alias("n"))


@query("K3_skeletonise")
def _(v):
    out = jobs.skeletonise(v.scan.filter("label = 4"), scan_ground(v), SPARSE, (15, 10, 5))
    return out["cylinders"]


@query("K4_assemble_trees")
def _(v):
    p = {**SPARSE, "grid_resolution": 2.0, "gap_connect": 1.0, "minimum_cci": 0.0, "slice_increment": 0.1}
    cyl = stacked(v).drop("tree_id", "parent_branch_id", "height_above_dtm", "main_stem")
    out = jobs.assemble_trees(cyl, v.dtm, p)
    return out.select("plot_id", "tree_id", "branch_id", "main_stem", *[half_even(F.col(c), 4).alias(c) for c in "xyz"], "radius")


def measured(v):
    pts = v.scan.withColumn("hag", F.col("z") - F.col("x") / 20.0).drop("tree", "gps_time", "intensity")
    return jobs.measure_trees(pts, scan_cylinders(v), scan_plots(v), SPARSE, min_left=0)


@query("K5_measure_trees")
def _(v):
    return measured(v)["trees"]


def model(v):
    """The segmentation step as a model gives it: the true class of a sample row likely, the others not."""
    def score(samples):
        truth = v.scan.select("plot_id", "point_id", *[F.when(F.col("label") == i + 1, 0.7).otherwise(0.1).alias(f"p{i}") for i in range(4)])
        return samples.select("plot_id", "point_id", "box_id").join(truth, ["plot_id", "point_id"])
    return score


# wide slices, so that a stem of the sparse scan has enough points in each
CHAIN = {**SPARSE, "minimum_cci": 0.0, "vegetation_coverage_resolution": 0.5, "slice_thickness": 0.6, "eps": 0.25, "gap_connect": 0.6, "min_tree_cyls": 5}


def chain(v):
    return jobs.measure_plots(v.scan.drop("tree"), scan_plots(v), CHAIN, model(v), (10, 10, 10))


@query("K1_K6_plot_summary")
def _(v):
    """All but the five run times, which differ from run to run."""
    out = chain(v)["plot_summary"]
    return out.select(*[c for c in out.columns if not c.endswith("(s)")])


@query("K8_prepare_training")
def _(v):
    pts = v.points.withColumn("plot_id", F.col("intensity"))
    return jobs.prepare_training(pts, minimum=5, cap=20).select("plot_id", "point_id", "box_id", "split")


@query("K13_combine_outputs", fx("fx_taper", "fx_plots") + f"SELECT 'plot_summary' AS kind, count(*) AS n, {even('sum(plot_radius)', 3)} AS total FROM fx_plots UNION ALL SELECT 'taper', count(*), {even('sum(ma_diameter)', 3)} FROM fx_taper")
def _(v):
    t, p = v.taper, v.plots
    out = jobs.combine_outputs({
        "plot_summary": [p.filter("plot_id < 2"), p.filter("plot_id >= 2").drop("n_sources")],
        "taper": [t.filter("plot_id < 2"), t.filter("plot_id >= 2").drop("cci")],
    })
    return out["plot_summary"].agg(F.lit("plot_summary").alias("kind"), F.count(F.lit(1)).alias("n"), half_even(F.sum("plot_radius"), 3).alias("total")).unionByName(
        out["taper"].agg(F.lit("taper").alias("kind"), F.count(F.lit(1)).alias("n"), half_even(F.sum("ma_diameter"), 3).alias("total"))
    )
