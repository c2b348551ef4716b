"""Neighbour search by chunks: against brute force on small chunks, and what it writes per row."""

import math
import random

import numpy as np
import pytest

from arborframe.operators import assemble, celltree, clean, measure, nearest

ROW = "plot_id int, {} long, x double, y double, z double"


def cloud(n, seed):
    """Half of the points in a small spot, some positions many times, on a raster that makes ties."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        wide = 4.0 if i % 2 else 0.2
        rows.append((i % 3 // 2, i, *[round(rnd.uniform(0, wide), 1 if i % 5 else 0) for _ in range(3)]))
    return rows


def dist(p, q):
    x, y, z = (a - b for a, b in zip(p[2:], q[2:]))
    return math.sqrt(x * x + y * y + z * z)


def brute(left, right, k, same, within):
    out = []
    for p in left:
        near = sorted((dist(p, q), q[1]) for q in right if q[0] == p[0] and not (same and q[1] == p[1]))
        out += [(p[1], i + 1, j, round(d, 9)) for i, (d, j) in enumerate([n for n in near if within is None or n[0] <= within][:k])]
    return sorted(out)


@pytest.mark.parametrize("k,same,within", [(1, True, 0.15), (3, False, None)])
def test_chunks_and_shares_equal_brute_force(spark, monkeypatch, k, same, within):
    monkeypatch.setattr(nearest, "CHUNK_ROWS", 64)
    monkeypatch.setattr(nearest, "LEFT_ROWS", 100)
    left = [*cloud(1500, 1), (0, 9000, 50.0, -30.0, 2.0), (1, 9001, 2.0, 2.0, -9.0), (7, 9002, 0.0, 0.0, 0.0)]
    right = left if same else cloud(2000, 2)
    a, b = spark.createDataFrame(left, ROW.format("a")), spark.createDataFrame(right, ROW.format("b"))
    got = nearest.nearest_rows(a, b, k, "a", "b", within=within, exclude_self=same, take=("z",)).collect()
    assert sorted((r.a, r["rank"], r.near_id, round(r.near_dist, 9)) for r in got) == brute(left, right, k, same, within)


def test_rows_of_an_id_share_their_neighbours(spark):
    left = spark.createDataFrame([(0, 1, 0.0, 0.0, 0.0), (0, 1, 5.0, 0.0, 0.0), (0, 2, 5.0, 0.0, 0.0)], ROW.format("a"))
    right = spark.createDataFrame([(0, i, float(i), 0.0, 0.0) for i in range(6)], ROW.format("b"))
    got = sorted((r.a, r["rank"], r.near_id) for r in nearest.nearest_rows(left, right, 2, "a", "b").collect())
    assert got == [(1, 1, 0), (1, 2, 5), (2, 1, 5), (2, 2, 4)]


def test_search_writes_few_rows_per_row(spark, monkeypatch):
    """Tables of the search together: a small multiple of its rows, not of its pairs or levels."""
    at = np.random.default_rng(4).uniform(0, 10, (6000, 3))
    rows = spark.createDataFrame([(0, i, *map(float, p)) for i, p in enumerate(at)], ROW.format("a"))
    written, cut = [], nearest.cut_lineage

    def counted(df):
        out = cut(df)
        written.append(out.count())
        return out

    monkeypatch.setattr(nearest, "cut_lineage", counted)
    assert nearest.nearest_rows(rows, rows, 5, "a", "a", exclude_self=True).count() == 30_000
    assert sum(written) < 8 * 6000, written


def test_thinning_makes_no_pairs_within_the_radius(spark, monkeypatch):
    rows = [(0, i, i % 20 / 100, i // 20 / 100, i % 7 / 100) for i in range(400)]
    points = spark.createDataFrame(rows, ROW.format("point_id"))
    monkeypatch.setattr(clean, "PAIR_MATES", 1e9)
    want = {r.point_id for r in clean.thin_min_spacing(points, 0.05).collect()}
    monkeypatch.setattr(clean, "PAIR_MATES", 0)

    def refuse(*_, **__):
        raise AssertionError("all pairs")

        monkeypatch.setattr(clean, "radius_pairs", refuse)
    assert {r.point_id for r in clean.thin_min_spacing(points, 0.05).collect()} == want


@pytest.mark.parametrize("own", [None, "_s"])
def test_large_sparse_clouds_are_thinned_without_pairs(spark, monkeypatch, own):
    """Chunks give what pairs give: ids of several plots, copies of positions, unknown coordinates and ids."""
    rows = [(*r, 0.3 if r[0] else 0.15) for r in cloud(1500, 3)] + [(0, 9000, None, 1.0, 1.0, 0.3), (0, None, 1.0, 1.0, 1.0, 0.3), (0, 9001, 0.1, 0.1, 0.1, None)]
    points = spark.createDataFrame(rows, ROW.format("point_id") + ", _s double")
    thin = lambda p: sorted(r.point_id for r in clean.thin_min_spacing(p, 0.3, spacing_col=own).collect())
    monkeypatch.setattr(clean, "PAIR_MATES", 1e9)
    want = thin(points)
    assert 9000 in want and len(want) < 1400

    def refuse(*_, **__):
        raise AssertionError("all pairs")

    monkeypatch.setattr(clean, "PAIR_ROWS", -1, raising=False)
    monkeypatch.setattr(clean, "THIN_ROWS", 64, raising=False)
    monkeypatch.setattr(clean, "closest_within", refuse)
    if own:
        monkeypatch.setattr(celltree, "CROWD", 0)
    assert thin(points if own else points.withColumn("more", clean.F.lit(1))) == want


CYLINDER = "plot_id int, cyl_id long, tree_id long, branch_id long, parent_branch_id long, x double, y double, z double, nx double, ny double, nz double, radius double"


@pytest.mark.parametrize("repeat", [False, True])
def test_growth_makes_no_pairs(spark, monkeypatch, repeat):
    rnd = random.Random(8)
    rows = [(i % 3 // 2, i, 0, i % 9, 0, rnd.choice((0.0, 0.1, 3.0)), rnd.choice((0.0, 0.2)), round(rnd.uniform(0, 6), 1), rnd.choice((0.0, 0.1)), 0.0, 1.0, rnd.randint(1, 30) / 100) for i in range(500)]
    rows += [(0, 900, 0, 1, 7, None, 0.0, 1.0, 0.0, 0.0, 1.0, 0.1), (0, 901, 0, 1, 7, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, 0.1), (0, 902, 0, 1, 7, 0.0, 0.0, 1.0, 0.0, 0.0, 1.0, None)]
    if repeat:
        rows += [(0, 3, 0, 5, 0, 0.0, 0.0, 2.0, 0.0, 0.0, 1.0, 0.2), (None, 904, 0, 1, 7, 0.0, 0.0, 1.0, 0.0, 0.0, 1.0, 0.1)]
    angle = lambda p, q: math.degrees(math.acos(max(-1.0, min(1.0, sum(a * b for a, b in zip(p, q)) / math.sqrt(sum(a * a for a in p) * sum(b * b for b in q))))))
    sound = [r for r in rows if None not in r and any(r[8:11])]
    best, followed = {}, set()
    for c in sound:
        for p in sound:
            near = c[0] == p[0] and (c[7], c[1]) > (p[7], p[1]) and math.dist(c[5:8], p[5:8]) <= 0.6 and c[11] < p[11] * 1.05 and angle(p[8:11], c[8:11]) <= 5
            if near:
                best[c[:2]] = max(best.get(c[:2], (-1.0,)), (p[7], p[1], p[3]))
                followed.add(p[:2])
    starts = {plot: [r[1] for r in sorted(rows, key=lambda r: (r[7] is not None, r[7] or 0, r[1])) if r[0] == plot and r[:2] not in best] for plot in (0, 1)}
    want = set()
    for r in rows:
        if r[:2] in followed:
            root = r[1]
            while (r[0], root) in best:
                root = best[r[0], root][1]
            want |= {(*r[:2], k + 1, best.get(r[:2], (0, 0, r[4]))[2]) for k, i in enumerate(starts[r[0]]) if i == root}

    def refuse(*_, **__):
        raise AssertionError("all pairs")

    monkeypatch.setattr(assemble, "radius_pairs", refuse)
    monkeypatch.setattr(assemble, "REACH_ROWS", 50, raising=False)
    monkeypatch.setattr(assemble, "REACH_BLOCK", 8, raising=False)
    monkeypatch.setattr(assemble, "REACH_STEP", 5, raising=False)
    got = assemble.grow_from_lowest(spark.createDataFrame(rows, CYLINDER), 0.6, 5.0).collect()
    assert {(r.plot_id, r.cyl_id, r.tree_id, r.parent_branch_id) for r in got} == want and len(want) > 300


@pytest.mark.parametrize("few", [0, 50_000])
@pytest.mark.parametrize("gap", [None, float("nan")])
def test_votes_become_a_label_where_they_are_found(spark, monkeypatch, few, gap):
    monkeypatch.setattr(nearest, "FEW_ROWS", few)
    monkeypatch.setattr(nearest, "CHUNK_ROWS", 64)
    rng = np.random.default_rng(5)
    votes = [(i % 2, i, *rng.integers(0, 6, 3).astype(float).tolist(), *rng.integers(0, 4, 2).astype(float).tolist()) for i in range(700 if not few else 60)]
    votes[7] = (*votes[7][:5], gap, 1.0)
    points = [(i % 3, i % 189, *(rng.random(3) * 6).tolist()) for i in range(200)]
    at = lambda r: np.array(r[2:5])
    want = {}
    for r in points:
        near = sorted((float(np.sqrt(((at(r) - at(v)) ** 2).sum())), v[1], v[5], v[6]) for v in votes if v[0] == r[0])[:5]
        want.setdefault(r[:2], []).extend(near)

    def median(values):
        kept = sorted((v for v in values if v is not None), key=lambda v: (np.isnan(v), v))
        return (kept[(len(kept) + 1) // 2 - 1] + kept[len(kept) // 2]) / 2

    def label(near):
        p = [median([n[c] for n in sorted(near, key=lambda n: n[:2])[:5]]) for c in (2, 3)]
        return int(np.argmax(p))

    seen = []
    rows = nearest.as_rows
    monkeypatch.setattr(nearest, "as_rows", lambda lists, *a: rows(seen.append(lists) or lists, *a))
    df = spark.createDataFrame(votes, "plot_id int, vote_id long, x double, y double, z double, p0 double, p1 double")
    pts = spark.createDataFrame(points, "plot_id int, point_id long, x double, y double, z double")
    got = {(r.plot_id, r.point_id): r.label for r in measure.label_vote(pts, df, 5).collect()}
    assert got == {key: label(near) for key, near in want.items() if near}
    if few and gap is not None:  # only lists of points that repeat an id are rows
        assert {r.point_id for lists in seen for r in lists.collect()} <= set(range(11))
