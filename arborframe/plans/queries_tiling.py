"""Box, voxel and sample queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from arborframe.functions.numeric import half_even
from arborframe.operators import tiling as ti
from arborframe.plans.queries_clean import BOX
from arborframe.plans.registry import query
from arborframe.plans.sqltext import even, fx, hash_sql

P = fx("fx_points").rstrip()
IDS = ("plot_id", "point_id")


def axes(size: float, overlap: float) -> str:
    cols = []
    for c in "xyz":
        n = f"CAST(ceil((max_{c} - min_{c}) / CAST({size} AS DOUBLE)) AS BIGINT)"
        steps = f"CAST(floor({n} / CAST({1 - overlap} AS DOUBLE)) + 1 AS BIGINT)"
        cols.append(f"min_{c} AS o_{c}, {steps} AS n_{c}, CASE WHEN {steps} > 1 THEN {n} * CAST({size} AS DOUBLE) / ({steps} - 1) ELSE {size} END AS s_{c}")
    return f"axes AS (SELECT plot_id, {', '.join(cols)} FROM ({BOX}))"


GRID = f""", {axes(6.0, 0.5)},
grid AS (SELECT plot_id, (ix * n_y + iy) * n_z + iz AS box_id, o_x + ix * s_x AS cx, o_y + iy * s_y AS cy, o_z + iz * s_z AS cz
  FROM (SELECT *, unnest(range(0, n_z)) AS iz FROM (SELECT *, unnest(range(0, n_y)) AS iy FROM (SELECT *, unnest(range(0, n_x)) AS ix FROM axes))))"""
# the check lists boxes per axis first, so it stays a range join instead of points x boxes
ASSIGN = f""", {axes(6.0, 0.5)},
""" + ",\n".join(
    f"a{c} AS (SELECT p.point_id, i AS i{c}, n_{c} FROM fx_points p JOIN (SELECT *, unnest(range(0, n_{c})) AS i FROM axes) a ON p.plot_id = a.plot_id AND {c} >= o_{c} + i * s_{c} - 3 AND {c} < o_{c} + i * s_{c} + 3)"
    for c in "xyz"
) + """,
boxed AS (SELECT p.*, (ix * n_y + iy) * n_z + iz AS box_id FROM fx_points p JOIN ax USING (point_id) JOIN ay USING (point_id) JOIN az USING (point_id))"""


@query("B1_box_grid", P + GRID + " SELECT plot_id, box_id, cx, cy, cz FROM grid")
def _(v):
    return ti.box_grid(v.points)


@query("B2_assign_boxes", P + ASSIGN + " SELECT plot_id, point_id, box_id FROM boxed")
def _(v):
    return ti.assign_boxes(v.points).select(*IDS, "box_id")


@query("B3_box_min_points", P + ASSIGN + " SELECT plot_id, point_id, box_id FROM boxed WHERE (plot_id, box_id) IN (SELECT (plot_id, box_id) FROM boxed GROUP BY plot_id, box_id HAVING count(*) > 50)")
def _(v):
    return ti.box_min_points(ti.assign_boxes(v.points), 50).select(*IDS, "box_id")


@query("B4_box_cap", P + ASSIGN + f" SELECT plot_id, point_id, box_id FROM boxed QUALIFY row_number() OVER (PARTITION BY plot_id, box_id ORDER BY {hash_sql('point_id', 1)}, point_id) <= 40")
def _(v):
    return ti.box_cap(ti.assign_boxes(v.points), 40).select(*IDS, "box_id")


CHUNK_AXES = ", ".join(
    f"floor(min(m{c})) - 3 AS o_{c}, CAST(ceil((ceil(max(m{c})) + 3 - floor(min(m{c})) + 3) / CAST(3 AS DOUBLE)) AS BIGINT) AS n_{c}" for c in "xyz"
)
CHUNKS = f""", means AS (SELECT plot_id, avg(x) AS ax, avg(y) AS ay, avg(z) AS az FROM fx_points GROUP BY plot_id),
moved AS (SELECT p.plot_id, point_id, x - ax AS mx, y - ay AS my, z - az AS mz FROM fx_points p JOIN means USING (plot_id)),
ca AS (SELECT plot_id, {CHUNK_AXES} FROM moved GROUP BY plot_id),
""" + ",\n".join(
    f"k{c} AS (SELECT p.point_id, i AS i{c}, n_{c} FROM moved p JOIN (SELECT *, unnest(range(0, n_{c})) AS i FROM ca) a ON p.plot_id = a.plot_id AND m{c} >= o_{c} + i * 3 AND m{c} <= o_{c} + i * 3 + 6)"
    for c in "xyz"
)


@query("B5_chunk_corner_boxes", P + CHUNKS + " SELECT p.plot_id, point_id, (ix * n_y + iy) * n_z + iz AS box_id FROM moved p JOIN kx USING (point_id) JOIN ky USING (point_id) JOIN kz USING (point_id)")
def _(v):
    return ti.chunk_corner_boxes(v.points).select(*IDS, "box_id")


SHIFT = ", ".join(f"{even(even(f'avg({c})', 9))} AS d{c}" for c in "xyz")


@query("B6_local_shift", P + ASSIGN + f", m AS (SELECT plot_id, box_id, {SHIFT} FROM boxed GROUP BY plot_id, box_id) SELECT plot_id, point_id, box_id, dx, dy, dz, {even('x - dx', 6)} AS x, {even('y - dy', 6)} AS y, {even('z - dz', 6)} AS z FROM boxed JOIN m USING (plot_id, box_id)")
def _(v):
    out = ti.local_shift(ti.assign_boxes(v.points))
    return out.select(*IDS, "box_id", "dx", "dy", "dz", *[half_even(F.col(c), 6).alias(c) for c in "xyz"])


VOX = ", ".join(f"floor({c} / CAST(2 AS DOUBLE)) * 2 AS v{c}" for c in "xyz")


@query("B7_voxelise", P + f" SELECT plot_id, point_id, {VOX} FROM fx_points")
def _(v):
    return ti.voxelise(v.points, 2.0).select(*IDS, "vx", "vy", "vz")


@query("B8_voxel_first", P + f" SELECT plot_id, min(point_id) AS point_id FROM (SELECT plot_id, point_id, {VOX} FROM fx_points) GROUP BY plot_id, vx, vy, vz")
def _(v):
    return ti.voxel_first(v.points, 2.0).select(*IDS)


MEDOID = f""", vox AS (SELECT plot_id, point_id, x, y, z, {VOX} FROM fx_points),
mid AS (SELECT plot_id, vx, vy, vz, median(x) AS mx, median(y) AS my, median(z) AS mz FROM vox GROUP BY ALL),
best AS (SELECT plot_id, point_id, row_number() OVER (PARTITION BY plot_id, vx, vy, vz ORDER BY {even('sqrt((x - mx) * (x - mx) + (y - my) * (y - my) + (z - mz) * (z - mz))', 9)}, point_id) AS r FROM vox JOIN mid USING (plot_id, vx, vy, vz))"""


@query("B9_voxel_medoid", P + MEDOID + " SELECT plot_id, point_id FROM best WHERE r = 1")
def _(v):
    return ti.voxel_medoid(v.points, 2.0).select(*IDS)


@query("B9_voxel_medoid_flag", P + MEDOID + " SELECT plot_id, point_id, r = 1 AS downsample FROM best")
def _(v):
    return ti.voxel_medoid(v.points, 2.0, flag=True).select(*IDS, "downsample")


@query("B10_augment")
def _(v):
    capped = ti.box_cap(ti.assign_boxes(v.points.withColumn("label", F.col("label") - 1)), 2000)
    return ti.augment(capped, min_points=30).select(*IDS, "box_id", "label", *[half_even(F.col(c), 5).alias(c) for c in "xyz"])


SPLIT = f""", box AS ({BOX}), parts AS (SELECT p.*, CASE WHEN y <= (min_y + max_y) / 2 THEN 'train' WHEN x <= (min_x + max_x) / 2 THEN 'validation' ELSE 'test' END AS split FROM fx_points p JOIN box USING (plot_id))"""


@query("B11_split_train_val_test", P + SPLIT + " SELECT plot_id, point_id, split FROM parts")
def _(v):
    return ti.split_train_val_test(v.points).select(*IDS, "split")


@query("B12_sample_accuracy", P + ASSIGN + f", acc AS (SELECT plot_id, box_id, avg(CASE WHEN label = 1 + intensity % 4 THEN 1.0 ELSE 0.0 END) AS a FROM boxed GROUP BY plot_id, box_id) SELECT plot_id, {even('avg(a)', 9)} AS accuracy FROM acc GROUP BY plot_id")
def _(v):
    boxed = ti.assign_boxes(v.points.withColumn("pred", 1 + F.col("intensity") % 4))
    return ti.sample_accuracy(boxed).withColumn("accuracy", half_even(F.col("accuracy"), 9))
