"""Results are whole: loops end on their own condition, and keys are (plot_id, point_id)."""

from pyspark.sql import functions as F

from arborframe.operators import clean, terrain, tiling


def chain(spark, n, spacing=0.01):
    return spark.createDataFrame([("p", i, i * spacing, 0.0, i * spacing * 0.1) for i in range(n)], "plot_id string, point_id long, x double, y double, z double")


def test_thinning_runs_until_nothing_is_pending(spark):
    out = clean.thin_min_spacing(chain(spark, 8), 0.015)
    kept = [r.x for r in out.orderBy("x").collect()]
    assert all(b - a >= 0.015 for a, b in zip(kept, kept[1:]))


def test_dem_closes_wide_gaps_of_every_plot(spark):
    rows = [(p, i, x, 0.25, 1.0, 1) for p, far in (("a", 2.25), ("b", 9.25)) for i, x in enumerate((0.25, far))]
    points = spark.createDataFrame(rows, "plot_id string, point_id long, x double, y double, z double, label int")
    got = {r.plot_id: r.n for r in terrain.make_dem(points).groupBy("plot_id").agg(F.count("*").alias("n")).collect()}
    assert got == {"a": 5, "b": 19}


def test_heights_with_ids_that_restart_per_plot(spark):
    points = spark.createDataFrame([("a", 1, 0.0, 0.0, 5.0), ("b", 1, 0.0, 0.0, 105.0)], "plot_id string, point_id long, x double, y double, z double")
    dtm = spark.createDataFrame([("a", 3.0, 0.0, 0.0), ("b", 3.0, 0.0, 100.0)], "plot_id string, x double, y double, z double")
    got = sorted((r.plot_id, r.hag) for r in terrain.hag_nearest(points, dtm, 0.5).collect())
    assert got == [("a", 5.0), ("b", 5.0)]


def test_medoid_flag_with_ids_that_restart_per_plot(spark):
    rows = [(p, i, 0.01 * i, 0.0, 0.0) for p in "ab" for i in range(3)]
    points = spark.createDataFrame(rows, "plot_id string, point_id long, x double, y double, z double")
    got = tiling.voxel_medoid(points, 1.0, flag=True)
    assert got.count() == 6 and got.filter("downsample").count() == 2


def test_far_range_filter_does_not_exchange_points(spark):
    """The per-plot facts are written first, so the join is a broadcast from the start."""
    points = chain(spark, 50).withColumn("label", F.lit(1))
    plan = tiling.assign_boxes(points, 6.0, 0.5)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning(plot_id" not in plan.split("BroadcastHashJoin")[1].split("BroadcastExchange")[0]
