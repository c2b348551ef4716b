"""Spatial joins and graph loops against brute force, with copies and a crowded spot."""

import itertools
import math
import random

import numpy as np
import pytest

from arborframe.operators import clean, field, graph, nearest, spatial, terrain, tiling

ROW = "plot_id int, {} long, x double, y double, z double"


def cloud(n, seed, crowded=0.35):
    """A third of the points in one spot, many of them exact copies."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        if rnd.random() < crowded:
            p = [1.0 + rnd.randrange(3) / 100, 1.0, 0.5]
        else:
            p = [round(rnd.uniform(-3, 3), 2), round(rnd.uniform(-3, 3), 2), round(rnd.uniform(0, 3), 2)]
        rows.append((i % 2, i, *p))
    return rows


def dist(a, b):
    return math.sqrt(sum((p - q) ** 2 for p, q in zip(a[2:], b[2:])))


@pytest.mark.parametrize("k,same", [(1, False), (4, False), (3, True)])
def test_knn_equals_brute_force(spark, k, same):
    left = cloud(120, 1)
    right = left if same else cloud(90, 2)
    got = spatial.knn_join(
        spark.createDataFrame(left, ROW.format("a")), spark.createDataFrame(right, ROW.format("b")), k, "a", "b", 0.2, exclude_self=same
    ).collect()
    got = sorted((r.a, r["rank"], r.near_id, round(r.near_dist, 9)) for r in got)
    want = []
    for p in left:
        near = sorted((dist(p, q), q[1]) for q in right if q[0] == p[0] and not (same and q[1] == p[1]))[:k]
        want += [(p[1], i + 1, j, round(d, 9)) for i, (d, j) in enumerate(near)]
    assert got == sorted(want)


def test_nearest_within_equals_brute_force(spark):
    left, right = cloud(150, 3), cloud(60, 4)
    got = nearest.nearest_within(spark.createDataFrame(left, ROW.format("a")), spark.createDataFrame(right, ROW.format("b")), 0.8, "a", "b").collect()
    assert len(got) == len(left)
    for r in got:
        near = sorted((dist((0, 0, r.x, r.y, r.z), q), q[1]) for q in right if q[0] == r.plot_id)
        near = [x for x in near if x[0] <= 0.8]
        assert (r.near_id, r.near_dist and round(r.near_dist, 9)) == ((near[0][1], round(near[0][0], 9)) if near else (None, None))


@pytest.mark.parametrize("k,same,within,coords", [(1, False, None, "xyz"), (4, False, None, "xyz"), (3, True, None, "xyz"), (2, False, 0.7, "xy"), (5, False, None, "xy")])
def test_cell_index_equals_brute_force(spark, k, same, within, coords):
    left = cloud(150, 1) + [(1, 900, -40.0, 7.0, 0.0), (2, 901, 0.0, 0.0, 0.0), (0, 902, None, 1.0, 1.0)]
    right = left if same else [*cloud(200, 2, 0.6), (0, 903, 30.0, 30.0, 3.0), (3, 904, 0.0, 0.0, 0.0), (0, 905, 1.0, None, None)]
    a, b = spark.createDataFrame(left, ROW.format("a")), spark.createDataFrame(right, ROW.format("b"))
    got = nearest.nearest_rows(a, b, k, "a", "b", tuple(coords), within=within, exclude_self=same, take=("z",)).collect()
    got = sorted((r.a, r["rank"], r.near_id, round(r.near_dist, 9)) for r in got)
    want, used = [], range(2, 2 + len(coords))
    known = lambda p: all(p[i] is not None for i in used)
    for p in filter(known, left):
        near = sorted((math.sqrt(sum((p[i] - q[i]) ** 2 for i in used)), q[1]) for q in right if q[0] == p[0] and known(q) and not (same and q[1] == p[1]))
        near = [x for x in near if within is None or x[0] <= within][:k]
        want += [(p[1], i + 1, j, round(d, 9)) for i, (d, j) in enumerate(near)]
    assert got == sorted(want)


def test_cell_index_of_empty_sides(spark):
    some, none = spark.createDataFrame(cloud(5, 1), ROW.format("a")), spark.createDataFrame([], ROW.format("b"))
    assert nearest.nearest_rows(some, none, 2, "a", "b").count() == 0
    assert nearest.nearest_rows(none, some, 1, "b", "a", take=("x",)).columns == ["plot_id", "b", "near_id", "near_dist", "rank", "x"]
    assert nearest.nearest_within(some, none, 1.0, "a", "b").filter("near_id IS NULL").count() == 5


def test_candidates_do_not_grow_with_density(spark):
    """Ten times the rows, half of them in a crowded corner: about as many candidates per row."""
    rnd = np.random.default_rng(3)
    per_row = []
    for n in (1500, 15_000):
        spots = np.concatenate([rnd.uniform(0, 10, (n // 2, 3)), rnd.uniform(0, 0.3, (n // 2, 3))])
        right = spark.createDataFrame([(0, i, *map(float, p)) for i, p in enumerate(spots)], ROW.format("b"))
        left = spark.createDataFrame([(0, i, *map(float, p)) for i, p in enumerate(rnd.uniform(0, 10, (400, 3)))], ROW.format("a"))
        a, b = nearest.prepared(left, right, 5, "a", "b", spatial.XYZ, ["plot_id"], ())
        per_row.append(nearest.candidates(a, b, 5, "a", "b", spatial.XYZ, ["plot_id"], None, ()).count() / 400)
    assert per_row[1] < 1.5 * per_row[0] and per_row[1] < 150, per_row


@pytest.mark.parametrize("parts", [1, 7])
def test_components_do_not_depend_on_partitioning(spark, parts):
    rnd = random.Random(5)
    edges = [(0, a, a + rnd.randrange(1, 3)) for a in range(0, 60) if a % 7] + [(0, 100, b) for b in range(101, 160)]
    df = spark.createDataFrame(edges, "plot_id int, u long, v long").repartition(parts)
    got = {r.node: r.component for r in graph.connected_components(df).collect()}
    label = {n: n for e in edges for n in e[1:]}
    for _ in label:
        for _, a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    assert got == label


@pytest.mark.parametrize("hub_edges", [5, 500])
def test_components_of_stars_and_chains(spark, monkeypatch, hub_edges):
    """A star of 3000 leaves whose centre is not its least node, hung on a chain."""
    monkeypatch.setattr(graph, "HUB_EDGES", hub_edges)
    edges = [(0, 2000, n) for n in range(1000, 4000)] + [(0, n, n + 1) for n in range(0, 40)] + [(0, 40, 1500), (1, 2000, 7), (1, 7, 7)]
    got = {(r.plot_id, r.node): r.component for r in graph.connected_components(spark.createDataFrame(edges, "plot_id int, u long, v long")).collect()}
    assert got == {**{(0, n): 0 for n in [*range(41), *range(1000, 4000)]}, (1, 2000): 7, (1, 7): 7}


def brute_clusters(rows, eps, min_samples):
    near = {p[1]: [q[1] for q in rows if q[0] == p[0] and dist(p, q) <= eps] for p in rows}
    core = {i for i, n in near.items() if len(n) >= min_samples}
    label = {i: i for i in core}
    for _ in core:
        for i in core:
            for j in near[i]:
                if j in core:
                    label[i] = label[j] = min(label[i], label[j])
    return label


@pytest.mark.parametrize("eps,m", [(0.4, 2), (0.6, 4)])
def test_density_clusters_equal_brute_force(spark, eps, m):
    rows = cloud(160, 6, 0.3)
    got = graph.density_clusters(spark.createDataFrame(rows, ROW.format("pid")), eps, m, "pid").collect()
    names = {r.pid: r.cluster_id for r in got}
    want = brute_clusters(rows, eps, m)
    assert set(names) == set(want)
    for a, b in itertools.combinations(sorted(want), 2):
        assert (names[a] == names[b]) == (want[a] == want[b])


@pytest.mark.parametrize("gap", [0.499, 0.501])
def test_crowded_cells_are_linked_by_their_parts(spark, gap, monkeypatch):
    """Two crowded spots whose nearest positions lie just within or just beyond eps: parts are
    judged, few points are opened; and the same without opening any point."""
    rnd = random.Random(8)
    rows = [(0, i, -rnd.random() * 0.2, rnd.random() * 0.2, rnd.random() * 0.2) for i in range(400)] + [(0, 400, 0.0, 0.1, 0.1)]
    rows += [(0, 500 + i, gap + rnd.random() * 0.2, rnd.random() * 0.2, rnd.random() * 0.2) for i in range(400)] + [(0, 900, gap, 0.1, 0.1)]
    for each in (graph.PAIRS_EACH, -1):
        monkeypatch.setattr(graph, "PAIRS_EACH", each)
        got = graph.density_clusters(spark.createDataFrame(rows, ROW.format("pid")), 0.5, 4, "pid").collect()
        assert len(got) == 802
        assert len({r.cluster_id for r in got}) == (1 if gap <= 0.5 else 2)


def test_paths_are_as_long_as_the_tree_is_deep(spark):
    """A chain of 37 branches with a thinner and a lower side branch each; every branch is a start."""
    rows = [(0, 3 * i, max(3 * i - 3, 0), 0.5, float(i)) for i in range(37)]
    rows += [(0, 3 * i + 1, 3 * i, 0.4, float(i + 1)) for i in range(37)] + [(0, 3 * i + 2, 3 * i, 0.6, -1.0) for i in range(37)]
    branches = spark.createDataFrame(rows, "plot_id int, branch_id long, parent_branch_id long, mean_radius double, z_min double")
    starts = branches.selectExpr("plot_id", "branch_id AS start_id", "z_min AS base_top")
    path, kids = graph.trace_paths(branches, starts)
    got = {}
    for r in path.collect():
        got.setdefault(r.start_id, {})[r.step] = r.branch_id
    children = {i: [r for r in rows if r[2] == i and r[1] != i] for _, i, *_ in rows}
    near = {}
    for _, i, _, _, low in rows:
        want = [i]
        while up := [c for c in children[want[-1]] if c[4] >= low]:
            want.append(min(up, key=lambda c: (-c[3], c[1]))[1])
        assert [got[i][k] for k in range(len(got[i]))] == want
        near[i] = {i, *(c[1] for w in want for c in children[w])}
    assert max(len(p) for p in got.values()) == 38
    seen = {}
    for r in kids.collect():
        seen.setdefault(r.start_id, set()).add(r.branch_id)
    assert seen == near


def test_gap_width_equals_brute_force(spark):
    rnd = random.Random(5)
    shapes = {"a": (13, 9, 3), "b": (1, 17, 1), "c": (40, 2, 2), "d": (1, 1, 1), "e": (6, 6, 36)}
    cells = [(p, x - 3, y + 2) for p, (w, h, _) in shapes.items() for x in range(w) for y in range(h)]
    valued = [c for p, (_, _, n) in shapes.items() for c in rnd.sample([c for c in cells if c[0] == p], n)]
    make = lambda rows: spark.createDataFrame(rows, "plot_id string, cx long, cy long")
    got = {r.plot_id: r.half for r in terrain.gap_width(make(cells), make(valued)).collect()}
    want = {p: max(1, *(min(max(abs(c[1] - v[1]), abs(c[2] - v[2])) for v in valued if v[0] == p) for c in cells if c[0] == p), 1) for p in shapes}
    assert got == want


def test_roots_and_paths(spark):
    edges = spark.createDataFrame([(0, i, i // 2) for i in range(1, 40)] + [(0, 0, 0)], "plot_id int, b long, p long")
    got = {r.b: r.root for r in graph.resolve_roots(edges, "b", "p").collect()}
    assert set(got.values()) == {0} and len(got) == 40
    # branch 2 is thicker but starts below the base's top
    rows = [(0, 1, 1, 0.2, 0.0), (0, 2, 1, 0.3, 0.5), (0, 3, 1, 0.1, 2.0), (0, 4, 3, 0.1, 3.0)]
    branches = spark.createDataFrame(rows, "plot_id int, branch_id long, parent_branch_id long, mean_radius double, z_min double")
    starts = spark.createDataFrame([(0, 1, 1.0)], "plot_id int, start_id long, base_top double")
    path, kids = graph.trace_paths(branches, starts)
    assert [r.branch_id for r in path.orderBy("step").collect()] == [1, 3, 4]
    assert sorted(r.branch_id for r in kids.collect()) == [1, 2, 3, 4]


def test_thinning_follows_the_rule(spark):
    rows = cloud(150, 7, 0.0)
    got = {r.point_id for r in clean.thin_min_spacing(spark.createDataFrame(rows, ROW.format("point_id")), 0.5).collect()}
    want = set()
    for plot in (0, 1):
        pending, first = [r for r in rows if r[0] == plot], True
        while pending and (first or len(pending) > 1):
            nxt = []
            for p in pending:
                near = sorted((dist(p, q), q[1], q[4]) for q in pending if q[1] != p[1])
                if not near or near[0][0] >= 0.5:
                    want.add(p[1])
                elif p[4] < near[0][2]:
                    nxt.append(p)
            pending, first = nxt, False
    assert got == want


def test_thinning_spacing_edge(spark):
    rows = [(0, 1, 0.0, 0.0, 0.0), (0, 2, 0.049, 0.0, 0.1), (0, 3, 1.0, 0.0, 0.0), (0, 4, 1.051, 0.0, 0.0)]
    flat = [(p, i, x, y, 0.0) for p, i, x, y, _ in rows]
    got = {r.point_id for r in clean.thin_min_spacing(spark.createDataFrame(flat, ROW.format("point_id")), 0.05).collect()}
    assert got == {3, 4}


def test_box_cap_is_exact_for_a_hot_box(spark):
    rows = spark.range(5000).selectExpr("0 AS plot_id", "IF(id % 3 = 0, id % 40, 99) AS box_id", "id AS point_id")
    counts = {r.box_id: r["count"] for r in tiling.box_cap(rows, 100).groupBy("box_id").count().collect()}
    sizes = {r.box_id: r["count"] for r in rows.groupBy("box_id").count().collect()}
    assert counts == {b: min(n, 100) for b, n in sizes.items()}


def test_box_borders_are_half_open(spark):
    rows = [(0, i, float(x), 0.0, 0.0) for i, x in enumerate((0, 3, 6, 9, 12))]
    got = tiling.assign_boxes(spark.createDataFrame(rows, ROW.format("point_id"))).collect()
    grid = {r.box_id: r.cx for r in tiling.box_grid(spark.createDataFrame(rows, ROW.format("point_id"))).collect()}
    assert sorted((r.point_id, grid[r.box_id]) for r in got) == sorted(
        (i, c) for i, (_, _, x, _, _) in enumerate(rows) for c in grid.values() if c - 3 <= x < c + 3
    )


def test_heights_outside_a_cropped_grid(spark):
    nodes = [(0, float(x), float(y), x + 10.0 * y) for x in range(3) for y in range(3)]
    dtm = spark.createDataFrame(nodes, "plot_id int, x double, y double, z double")
    pts = [(0, 1, 0.2, 0.3, 5.0), (0, 2, 9.0, 1.2, 5.0), (0, 3, -4.0, -7.0, 5.0)]
    got = {r.point_id: r.hag for r in terrain.hag_nearest(spark.createDataFrame(pts, ROW.format("point_id")), dtm, 1.0).collect()}
    assert got == {1: 5.0, 2: 5.0 - 12.0, 3: 5.0}


def test_qc_matching_is_the_sequential_rule(spark):
    rnd = random.Random(9)
    qc = [(0, i, rnd.uniform(0, 1.5), rnd.uniform(0, 1.5)) for i in range(60)]
    trees = [(0, i, rnd.uniform(0, 1.5), rnd.uniform(0, 1.5)) for i in range(40)]
    m, rest = field.match_qc_trees(
        spark.createDataFrame(qc, "plot_id int, qc_id long, x double, y double"), spark.createDataFrame(trees, "plot_id int, tree_id long, x double, y double"), 0.2
    )
    free, want = dict((t[1], t) for t in trees), {}
    for q in qc:
        near = sorted((math.hypot(q[2] - t[2], q[3] - t[3]), t[1]) for t in free.values())
        if near and near[0][0] < 0.2:
            want[q[1]] = near[0][1]
            del free[near[0][1]]
    assert {r.qc_id: r.target for r in m.collect()} == want
    assert {r.qc_id for r in rest.collect()} == {q[1] for q in qc} - set(want)


def test_hull_of_a_crowded_grid(spark):
    pts = [(0, float(x), float(y)) for x in range(5) for y in range(4)] + [(0, 2.0, 2.0)] * 50
    hull = terrain.convex_hull(spark.createDataFrame(pts, "plot_id int, x double, y double").repartition(5))
    assert {(r.x, r.y) for r in hull.collect()} == {(0.0, 0.0), (4.0, 0.0), (4.0, 3.0), (0.0, 3.0)}
    assert terrain.hull_area(hull).first().hull_area == pytest.approx(12.0)


def test_plane_slope(spark):
    pts = [(0, float(x), float(y), 0.1 * x + 0.05 * y) for x in range(6) for y in range(6)]
    r = terrain.plot_gradient(spark.createDataFrame(pts, "plot_id int, x double, y double, z double")).first()
    assert r.avg_gradient == pytest.approx(math.degrees(math.atan(math.hypot(0.1, 0.05))), abs=1e-5)
    assert r.avg_gradient_x == pytest.approx(math.degrees(math.atan(0.1)), abs=1e-5)


def test_ground_radius_with_few_points(spark):
    """A plot with at most 100 points uses all of them instead of growing forever."""
    rows = [(0, i, i % 6 * 1.0, i // 6 * 1.0, float(i), 1) for i in range(30)]
    df = spark.createDataFrame(rows, ROW.format("point_id") + ", label int")
    z = {r.z for r in terrain.make_dtm(df, None, 1.0).collect()}
    assert len(z) == 1 and z.pop() == pytest.approx(np.percentile(range(30), 2.5))


@pytest.mark.parametrize("indexed", [True, False])
def test_heights_above_grids_of_any_origin_and_spacing(spark, indexed):
    """Spacing 0.3 m from an origin off its multiples, a hole and points outside: the nearest node, and its triangle."""
    rnd = random.Random(11)
    nodes = [(0, i, j, 0.17 + 0.3 * i, -1.05 + 0.3 * j, round(rnd.uniform(0, 2), 3)) for i in range(8) for j in range(7) if (i, j) not in ((3, 3), (0, 0))]
    grid = spark.createDataFrame(nodes, "plot_id int, gx long, gy long, x double, y double, z double")
    grid = grid if indexed else grid.drop("gx", "gy")
    points = [(0, k, rnd.uniform(-0.5, 3.0), rnd.uniform(-1.6, 1.4), 5.0) for k in range(300)]
    cloud_ = spark.createDataFrame(points, ROW.format("point_id"))
    got = {r.point_id: r.hag for r in terrain.hag_nearest(cloud_, grid, 0.3).collect()}
    assert len(got) == 300
    for _, k, x, y, z in points:
        d, ground = min((math.hypot(x - n[3], y - n[4]), n[5]) for n in nodes)
        assert got[k] == pytest.approx(z - ground)
    height = {(n[1], n[2]): n[5] for n in nodes}
    middle = float(np.median([n[5] for n in nodes]))
    got = {r.point_id: r.hag for r in terrain.hag_linear(cloud_, grid, 0.3).collect()}
    assert len(got) == 300
    for _, k, x, y, z in points:
        i, j = math.floor((x - 0.17) / 0.3), math.floor((y + 1.05) / 0.3)
        tx, ty = (x - 0.17) / 0.3 - i, (y + 1.05) / 0.3 - j
        corners = {(a, b): height.get((i + a, j + b)) for a in (0, 1) for b in (0, 1)}
        main = corners[0, 0] is not None and corners[1, 1] is not None
        used = [(0, 0), (1, 1), (1, 0) if tx >= ty else (0, 1)] if main else [(1, 0), (0, 1), (0, 0) if tx + ty <= 1 else (1, 1)]
        if any(corners[c] is None for c in used):
            ground = middle
        else:
            rows = np.array([[*c, 1.0] for c in used], dtype=float)
            ground = float(np.linalg.solve(rows, np.array([corners[c] for c in used])) @ np.array([tx, ty, 1.0]))
        assert got[k] == pytest.approx(z - ground)


def test_heights_above_nodes_that_form_no_grid(spark):
    rnd = random.Random(12)
    nodes = [(0, i, round(rnd.uniform(0, 5), 2), round(rnd.uniform(0, 5), 2), float(i)) for i in range(40)]
    points = [(0, k, rnd.uniform(0, 5), rnd.uniform(0, 5), 50.0) for k in range(100)] + [(3, 200, 1.0, 1.0, 1.0)]
    got = {r.point_id: r.hag for r in terrain.hag_nearest(spark.createDataFrame(points, ROW.format("point_id")), spark.createDataFrame(nodes, ROW.format("node_id")), 1.0).collect()}
    assert got == {k: pytest.approx(z - min((math.hypot(x - n[2], y - n[3]), n[4]) for n in nodes)[1]) for p, k, x, y, z in points if p == 0}
