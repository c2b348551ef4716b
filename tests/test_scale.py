"""What grows with the input: joins through the driver, shuffles of whole tables, tasks and files."""

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from arborframe import fixtures
from arborframe.lineage import cut_lineage
from arborframe.operators import assemble, shapes, spatial, stems, tiling
from arborframe.plans import catalog, queries_geometry
from arborframe.sources import points as so

BY = ("plot_id", "section_id")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def sections(spark, n=4):
    """Rows that a view explodes from a few: statistics give the size of the few."""
    rows = spark.range(n).select(F.lit(0).alias("plot_id"), F.col("id").alias("section_id"), F.explode(F.sequence(F.lit(0), F.lit(39))).alias("point_id"))
    turn = F.radians(F.col("point_id") * 9)
    return rows.withColumns({"u": 0.2 * F.cos(turn), "v": 0.2 * F.sin(turn) + F.col("section_id")})


def test_circle_fits_send_no_points_through_the_driver(spark):
    rows = cut_lineage(sections(spark))
    rows = rows.select("plot_id", "section_id", "u", "v", "point_id")
    out = stems.circle_fit(rows, BY, trials=8)
    got = sorted((r.section_id, round(r.cv, 6), round(r.radius, 6), r.n_inliers) for r in out.collect())
    assert got == [(i, float(i), 0.2, 40) for i in range(4)]
    assert "BroadcastHashJoin" not in plan(out)


@pytest.mark.parametrize("mode", ["even", "reference"])
def test_completeness_sends_no_points_through_the_driver(spark, mode):
    rows = sections(spark).filter("section_id = 0 OR point_id >= 20")
    circles = sections(spark).select(*BY).distinct().withColumns({"cu": F.lit(0.0), "cv": F.col("section_id").cast("double"), "radius": F.lit(0.2)})
    out = stems.circumferential_completeness(rows, circles, BY, mode)
    assert out.count() == 4
    assert "BroadcastHashJoin" not in plan(out)


def test_candidates_are_the_hash_picked_points(spark):
    rows = sections(spark, 2).filter("section_id = 0 OR point_id % 3 = 0")
    got = stems.circle_candidates(rows, BY, 16, 7).collect()
    assert len({(r.section_id, r.trial) for r in got}) == len(got)
    assert {r.n_points for r in got if r.section_id == 0} == {40} and {r.n_points for r in got if r.section_id == 1} == {14}
    assert all(abs(r.cr - 0.2) < 1e-9 and abs(r.cv - r.section_id) < 1e-9 for r in got)


def test_radius_pairs_sends_no_side_through_the_driver(spark):
    rows = sections(spark).select("plot_id", F.col("point_id").alias("id"), F.col("u").alias("x"), F.col("v").alias("y"), F.lit(0.0).alias("z"))
    out = spatial.radius_pairs(rows, rows.limit(5), 0.1)
    assert out.count() > 0
    assert "BroadcastHashJoin" not in plan(out)


def test_smoothing_takes_copies_of_a_position_once(spark):
    names = "plot_id int, cyl_id long, tree_id long, x double, y double, z double, nx double, ny double, nz double, radius double, cci double"
    rows = [(0, i, 0, 0.0, 0.0, i // 50 / 10, 0.0, 0.0, 1.0, 0.1 + i % 50 / 1000, float(i % 50)) for i in range(200)]
    out = stems.smooth_cylinders(spark.createDataFrame(rows, names))
    # only the written ids that repeat may be broadcast
    assert plan(out).count("BroadcastHashJoin") <= 1
    got = {r.cyl_id: (round(r.radius, 6), round(r.cci, 6), r.z) for r in out.collect()}
    # the seven nearest are the first seven ids at the own position
    assert got == {i: (0.103, 3.0, i // 50 / 10) for i in range(200)}


def test_boxes_meet_their_facts_without_a_shuffle_of_the_samples(spark):
    rows = spark.range(400).select(
        F.lit(0).alias("plot_id"), (F.col("id") % 4).alias("box_id"), F.col("id").alias("point_id"), *[F.col("id").cast("double").alias(c) for c in "xyz"]
    )
    rows = cut_lineage(rows)
    shifted, large = tiling.local_shift(rows), tiling.box_min_points(rows, 50)
    assert shifted.count() == large.count() == 400
    assert "Exchange hashpartitioning" not in plan(shifted) + plan(large)
    assert tiling.box_cap(rows, 10).groupBy("box_id").count().filter("count <> 10").isEmpty()


def test_exploding_views_are_dealt_over_tasks(spark, tmp_path):
    spark.range(45_000).select(F.col("id").alias("c_custkey")).coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    rows = fixtures.view(spark, str(tmp_path), "fx_sections")
    per = rows.groupBy(F.spark_partition_id()).agg(F.countDistinct("section_id").alias("n")).collect()
    assert sum(r.n for r in per) == 45_000 and max(r.n for r in per) < 30_000


def test_a_writing_task_holds_a_bounded_number_of_rows(spark, tmp_path):
    so.write_by(spark.range(2_500_000).select(F.lit(0).alias("plot_id"), "id"), f"{tmp_path}/out", "plot_id")
    sizes = [pq.read_metadata(f).num_rows for f in glob.glob(f"{tmp_path}/out/plot_id=0/*.parquet")]
    assert sum(sizes) == 2_500_000 and max(sizes) <= 1_000_000


def test_smoothing_counts_the_pairs_of_repeated_ids(spark):
    names = "plot_id int, cyl_id long, tree_id long, x double, y double, z double, nx double, ny double, nz double, radius double, cci double"
    rows = [(0, i, 0, 0.0, 0.0, float(i), 0.0, 0.0, 1.0, 0.1, float(i)) for i in range(20)]
    out = stems.smooth_cylinders(spark.createDataFrame([*rows, rows[0]], names))
    got = sorted((r.cyl_id, round(r.cci, 6)) for r in out.collect())
    # id 0 twice: four pairs with itself, two with 1, one with 2; id 10 meets 7 to 13
    assert got[:2] == [(0, round(4 / 7, 6))] * 2 and (10, 10.0) in got and len(got) == 21


def text_labels(spark):
    """Labels with characters without a glyph, and null texts and places."""
    rows = [(1, "AB?A", 1.0, 2.0, 3.0, 0.5), (2, "B", None, 2.0, 3.0, 0.5), (3, "\U0001f332AA", 1.5, None, 0.25, 0.0), (4, "A", 1.0, 2.0, None, None)]
    rows += [(5, None, 1.0, 2.0, 3.0, 0.5), (6, "", 1.0, 2.0, 3.0, 0.5), (7, "??", 1.0, 2.0, 3.0, 0.5), (1, "AB?A", 1.0, 2.0, 3.0, 0.5)]
    labels = spark.createDataFrame(rows, "label_id int, text string, x double, y double, z double, shift double")
    bits = [("A", 0, 0), ("A", 10, 3), ("B", 4, 10), ("B", 4, 10), ("\U0001f332", 1, 2), (None, 1, 1)]
    return rows, labels, bits, spark.createDataFrame(bits, "ch string, row int, col int")


def text_points(rows, bits):
    tilt, out = 0.5**0.5, []
    for row in rows:
        _, text, x, y, z, shift = row
        for i, c in enumerate(text or ""):
            for r, col in [(r, col) for ch, r, col in bits if ch == c]:
                up = (10 - r) * tilt * 0.00256
                px = None if x is None or shift is None else (i * 11 + col) * 0.00256 + x + 0.2 + 0.5 * shift
                out.append((*row, px, None if y is None else up + y, None if z is None else up + z))
    return out


def test_text_points_are_the_set_bits_of_every_character(spark, monkeypatch):
    rows, labels, bits, glyphs = text_labels(spark)
    monkeypatch.setattr(shapes, "BLOCK_CHARS", 2)
    got = shapes.annotate_points(labels, glyphs)
    assert got.columns == [*labels.columns, "px", "py", "pz"]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, text_points(rows, bits)))


def test_text_points_are_added_up_by_the_task_that_makes_them(spark):
    rows, labels, bits, glyphs = text_labels(spark)
    points = text_points(rows, bits)
    out = shapes.annotate_points(labels, glyphs, sums=True)
    assert "Join" not in plan(out) and plan(out).count("ArrowEvalPython") == 1
    got = out.collect()
    assert len(got) == len(rows)
    for r in got:
        own = [p[-3:] for p in points if p[0] == r.label_id]
        times = sum(q[0] == r.label_id for q in rows)
        assert r.n_points * times == len(own)
        for total, column in zip((r.sum_px, r.sum_py, r.sum_pz), zip(*own)):
            assert total is None if None in column else total == pytest.approx(sum(column) / times)


def test_trees_are_dealt_over_tasks_before_they_become_points(spark, tmp_path, monkeypatch):
    """By the size of the rows adaptive execution would make one task of them."""
    lines = spark.range(400).select(
        F.col("id").alias("l_orderkey"), F.lit(1).alias("l_linenumber"), F.lit(30.0).alias("l_quantity"), (F.col("id") % 7).alias("l_suppkey"), F.col("id").alias("l_partkey")
    )
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(10).select(F.col("id").alias("s_suppkey")).write.parquet(f"{tmp_path}/supplier.parquet")
    monkeypatch.setattr(queries_geometry, "TREES_A_TASK", 20)
    out = catalog.QUERIES["O3_annotate_points"](spark, str(tmp_path))
    assert "REPARTITION_BY_NUM" in plan(out) and "hashpartitioning(plot_id" in plan(out).split("REPARTITION_BY_NUM")[0].rsplit("\n", 1)[1]
    got = out.collect()
    assert len(got) == 400 and all(r.n > 3000 for r in got)


def test_segment_parents_place_ends_by_one_generator(spark, monkeypatch):
    # with a generator per coordinate the optimizer inferred constraints through every alias until the driver's heap was full
    rows = [(0, 10 * b + i, b, 0.0, 0.0, float(6 * b + i) / 2, 0.0, 0.0, 1.0, 0.1, 90.0) for b in range(2) for i in range(6)]
    cylinders = spark.createDataFrame(rows, "plot_id int, cyl_id long, branch_id long, x double, y double, z double, nx double, ny double, nz double, radius double, cci double")
    seen = []

    def written(df):
        seen.append(df._jdf.queryExecution().optimizedPlan().toString().count("Generate "))
        return cut_lineage(df)

    monkeypatch.setattr(assemble, "cut_lineage", written)
    links, _ = assemble.segment_parents(cylinders.withColumn("x", F.col("x") + 0.2 * F.col("branch_id")))
    assert [(r.branch_id, r.parent_branch_id, r.parent_cyl_id) for r in links.collect()] == [(1, 0, 5)]
    assert max(seen) == 1


@pytest.mark.parametrize("coords", [("x",), ("x", "y"), ("x", "y", "z")])
def test_radius_pairs_equal_all_pairs_near(spark, coords):
    at = [(i, i % 5 * 0.7 - 1.4, i % 7 * 0.45 - 1.0, (i * 3 % 11) * 0.3) for i in range(40)]
    rows = spark.createDataFrame([(i % 2, i, x, y, z) for i, x, y, z in at] + [(0, 90, None, 0.0, 0.0)], "plot_id int, id long, x double, y double, z double")
    use = ["xyz".index(c) + 1 for c in coords]
    want = sorted((a[0], b[0]) for a in at for b in at if a[0] % 2 == b[0] % 2 and sum((a[c] - b[c]) ** 2 for c in use) ** 0.5 <= 0.61)
    for size in (None, 0.25, 1.7):
        got = spatial.radius_pairs(rows, rows, 0.61, coords, size=size).select("id", "near.id").collect()
        assert sorted(map(tuple, got)) == want
