"""Graph loops: components, root lookup, path tracing and density clusters."""

from __future__ import annotations

import itertools
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arborframe.lineage import cut_lineage, release
from arborframe.operators.nearest import Boxes
from arborframe.operators.spatial import XYZ, cell, radius_pairs


#: A node of more edges than this is a hub; its edges are dealt to so many tasks.
HUB_EDGES, SALTS = 500, 64


def connected_components(edges: DataFrame, by: Sequence[str] = ("plot_id",)) -> DataFrame:
    """(by, node, component) for every node on an edge (columns u, v); component = smallest node.

    Alternating large-star / small-star rounds; rounds grow with the log of the graph's
    width. A hub's edges are never dealt by its id alone: a node's least neighbour is an
    aggregate with a map-side part over (node, salt) first, the few rows of that per node
    are merged and written, and the edges meet them dealt by (node, salt), where every
    written minimum has one copy per salt of its node. Nodes of few edges have one salt.
    """
    by = list(by)
    u, v = F.col("u"), F.col("v")

    def state(e: DataFrame):
        return e.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*e.columns).cast("decimal(38,0)"))).first()

    def pairs(e: DataFrame, a, b) -> DataFrame:
        return e.select(*by, a.alias("u"), b.alias("v"))

    def with_least(e: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(edges with the least neighbour m of their u, written table of u and m)."""
        salted = F.pmod(F.xxhash64("v"), F.lit(SALTS))
        part = e.groupBy(*by, "u", salted.alias("_salt")).agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("_n"))
        low = cut_lineage(part.groupBy(*by, "u").agg(F.min("m").alias("m"), F.sum("_n").alias("_n")))
        hubs = low.filter(F.col("_n") > HUB_EDGES)
        if hubs.isEmpty():
            return e.join(low.select(*by, "u", "m"), [*by, "u"]), low
        few = e.join(low.filter(F.col("_n") <= HUB_EDGES).select(*by, "u", "m"), [*by, "u"])
        copies = hubs.select(*by, "u", "m", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("_salt"))
        many = e.withColumn("_salt", salted).join(copies, [*by, "u", "_salt"]).drop("_salt")
        return few.unionByName(many), low

    work = cut_lineage(pairs(edges, F.greatest(u, v), F.least(u, v)).filter("u <> v").distinct())
    seen = state(work)
    while True:
        met, low = with_least(work.unionByName(pairs(work, v, u)))
        large = met.filter(v > u).select(*by, v.alias("u"), F.least("m", "u").alias("v")).filter("u <> v")
        large = cut_lineage(large)
        linked, lower = with_least(large)
        small = pairs(linked, v, F.col("m")).filter("u <> v").unionByName(pairs(lower, u, F.col("m")))
        small = pairs(small, F.greatest(u, v), F.least(u, v)).distinct()
        last, work = work, cut_lineage(small)
        release(last, low, large, lower)
        now = state(work)
        if now == seen:
            break
        seen = now
    roots = work.select(*by, F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return work.select(*by, F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def resolve_roots(edges: DataFrame, node: str, parent: str, by: Sequence[str] = ("plot_id",)) -> DataFrame:
    """(by, node, root) by pointer jumping; a root points to itself. Rows whose parent is
    not a node keep that parent as root. Rounds grow with the log of the depth; pointers
    that still move after that many rounds form a cycle, which is an error in the input."""
    by = list(by)
    now = cut_lineage(edges.select(*by, F.col(node).alias("node"), F.col(parent).alias("root")))
    for _ in range(now.count().bit_length() + 2):
        step = now.select(*by, F.col("node").alias("root"), F.col("root").alias("_next"))
        nxt = now.join(step, [*by, "root"], "left").select(*by, "node", F.coalesce("_next", "root").alias("_new"), F.col("root").alias("_old"))
        last, nxt = now, cut_lineage(nxt)
        release(last)
        now = nxt.select(*by, "node", F.col("_new").alias("root"))
        now._scratch_path = nxt._scratch_path
        if nxt.filter("_new <> _old").isEmpty():
            return now.withColumnRenamed("node", node)
    raise RuntimeError("parent pointers form a cycle")


def trace_paths(branches: DataFrame, starts: DataFrame, by: Sequence[str] = ("plot_id",)) -> tuple[DataFrame, DataFrame]:
    """Climb from each start to the thickest child that begins no lower than the start's top.

    branches(by, branch_id, parent_branch_id, mean_radius, z_min), starts(by, start_id,
    base_top). Returns (path, children): the visited branches with their step, and all
    children of visited branches plus the start itself.

    Pointer doubling: the descendants of the starts and their distances double in reach per
    round; among them every (start, branch) has one best child, and the table of best
    children is doubled until no path goes on. Rounds grow with the log of the depth, tables
    are at most branches times depth. Parents in a cycle are an error in the input.
    """
    by = list(by)
    key = [*by, "start_id"]
    child = branches.filter("branch_id <> parent_branch_id").select(
        *by, F.col("parent_branch_id").alias("cur"), "branch_id", "mean_radius", "z_min"
    )
    starts = cut_lineage(starts.select(*key, "base_top"))
    below = cut_lineage(child.select(*by, F.col("cur").alias("top"), "branch_id", F.lit(1).alias("d")).distinct())
    for bits in range(branches.count().bit_length() + 2):
        far = below.filter(F.col("d") == 2**bits).select(*by, "top", F.col("branch_id").alias("mid"))
        longer = far.join(below.withColumnRenamed("top", "mid"), [*by, "mid"])
        longer = cut_lineage(longer.select(*by, "top", "branch_id", (F.col("d") + 2**bits).alias("d")))
        if longer.isEmpty():
            release(longer)
            break
        last, below = below, cut_lineage(below.unionByName(longer))
        release(last, longer)
    else:
        raise RuntimeError("parent pointers form a cycle")

    seen = below.join(starts.withColumn("top", F.col("start_id")), [*by, "top"]).select(*key, "base_top", F.col("branch_id").alias("cur"))
    seen = seen.unionByName(starts.select(*key, "base_top", F.col("start_id").alias("cur")))
    first = F.struct((-F.col("mean_radius")).alias("r"), "branch_id")
    jump = seen.join(child, [*by, "cur"]).filter(F.col("z_min") >= F.col("base_top")).groupBy(*key, "cur").agg(F.min(first).alias("_best"))
    jump = cut_lineage(jump.select(*key, "cur", F.col("_best.branch_id").alias("ahead")))
    release(below)
    path = cut_lineage(starts.select(*key, F.lit(0).alias("step"), F.col("start_id").alias("branch_id")))
    for bits in itertools.count():  # ends: paths are no longer than the depth
        # the path holds the steps below 2**bits, the jumps lead 2**bits steps ahead
        further = path.join(jump.withColumnRenamed("cur", "branch_id"), [*key, "branch_id"])
        further = cut_lineage(further.select(*key, (F.col("step") + 2**bits).alias("step"), F.col("ahead").alias("branch_id")))
        if further.isEmpty():
            release(further, jump)
            break
        last, path = path, cut_lineage(path.unionByName(further))
        release(last, further)
        twice = jump.join(jump.select(*key, F.col("cur").alias("ahead"), F.col("ahead").alias("_then")), [*key, "ahead"])
        last, jump = jump, cut_lineage(twice.select(*key, "cur", F.col("_then").alias("ahead")))
        release(last)
    kids = path.withColumnRenamed("branch_id", "cur").join(child, [*by, "cur"]).select(*key, "branch_id")
    return path, kids.unionByName(starts.select(*key, F.col("start_id").alias("branch_id"))).distinct()


#: Points of undecided cell pairs are opened once they make at most so many pairs per core point.
PAIRS_EACH = 20
#: Halvings after which the points are opened in any case; cells of that width hold one position.
MOST_HALVINGS = 40


def linked_cells(core: DataFrame, eps: float, side: float, coords: Sequence[str], by: Sequence[str]) -> DataFrame:
    """(by, u, v): pairs of cells, named by ``_rep``, that hold two positions within ``eps``.

    core(by, coords, _rep): distinct positions, ``_rep`` one name per cell of width ``side``
    (at least eps / sqrt(d)). Neighbouring cells are compared by the boxes of their positions:
    a greatest distance within eps links them, a least distance beyond eps drops them. The
    undecided pairs are split into halves of both cells and judged again; a pair is done at
    its first certain halves. Boxes of one position are always decided. Points are opened
    when few pairs are left, so the pairs made do not grow with the points in a cell.
    """
    by, boxes = list(by), Boxes(coords)
    index = [f"i{k}" for k in range(boxes.d)]
    ends = ("u", "v")

    def halved(level: int) -> DataFrame:
        """Occupied parts of the cells after ``level`` halvings with their positions' box."""
        parts = core.withColumns({i: cell(F.col(c), side / 2**level) for i, c in zip(index, coords)})
        return parts.groupBy(*by, "_rep", *index).agg(F.count(F.lit(1)).alias("n"), *boxes.around("b"))

    def as_end(parts: DataFrame, end: str) -> DataFrame:
        names = {"_rep": end, "n": f"n_{end}", **{i: f"{end}_{i}" for i in index}, **dict(zip(boxes.of("b"), boxes.of(end)))}
        return parts.withColumnsRenamed(names)

    def judged(pairs: DataFrame) -> DataFrame:
        near = pairs.filter(boxes.least("u", "v") <= eps).withColumn("sure", boxes.greatest("u", "v") <= eps)
        return cut_lineage(near.select(*by, *ends, "sure", "n_u", "n_v", *[f"{e}_{i}" for e in ends for i in index]))

    reach = int(boxes.d**0.5) + 1
    steps = [o for o in itertools.product(range(-reach, reach + 1), repeat=boxes.d) if o > (0,) * boxes.d]
    whole = cut_lineage(halved(0))
    around = as_end(whole, "u").withColumn("_o", F.explode(F.array(*[F.array(*[F.lit(x) for x in o]) for o in steps])))
    around = around.withColumns({f"v_{i}": F.col(f"u_{i}") + F.col("_o")[k] for k, i in enumerate(index)}).drop("_o")
    pairs = judged(around.join(as_end(whole, "v"), [*by, *[f"v_{i}" for i in index]]))
    found = [pairs.filter("sure").select(*by, *ends)]
    left = pairs.filter("NOT sure")
    rows = whole.agg(F.sum("n")).first()[0] or 0
    level = 0
    while work := left.agg(F.sum(F.col("n_u") * F.col("n_v"))).first()[0]:
        if work <= PAIRS_EACH * rows or level == MOST_HALVINGS:
            placed = core.withColumns({i: cell(F.col(c), side / 2**level) for i, c in zip(index, coords)}).select(*by, "_rep", *index, *coords)
            a, b = (placed.withColumnsRenamed({"_rep": e, **{i: f"{e}_{i}" for i in index}, **{c: f"{e}_{c}" for c in coords}}) for e in ends)
            met = left.join(a, [*by, "u", *[f"u_{i}" for i in index]]).join(b, [*by, "v", *[f"v_{i}" for i in index]])
            distance = Boxes.norm([F.col(f"u_{c}") - F.col(f"v_{c}") for c in coords])
            found.append(cut_lineage(met.filter(distance <= eps).select(*by, *ends).distinct()))
            break
        level += 1
        parts = cut_lineage(halved(level))
        split = left.select(*by, *ends, *[f"{e}_{i}" for e in ends for i in index]).withColumnsRenamed({f"{e}_{i}": f"{e}_up_{i}" for e in ends for i in index})
        for e in ends:
            inner = as_end(parts, e).withColumns({f"{e}_up_{i}": F.call_function("shiftright", F.col(f"{e}_{i}"), F.lit(1)) for i in index})
            split = split.join(inner, [*by, e, *[f"{e}_up_{i}" for i in index]])
        pairs = judged(split)
        hit = cut_lineage(pairs.filter("sure").select(*by, *ends).distinct())
        found.append(hit)
        left = cut_lineage(pairs.filter("NOT sure").join(hit, [*by, *ends], "left_anti"))
        release(pairs, parts)
    return reduce(DataFrame.unionByName, found)


def density_clusters(
    rows: DataFrame,
    eps: float,
    min_samples: int,
    row_id: str,
    by: Sequence[str] = ("plot_id",),
    coords: Sequence[str] = XYZ,
    min_size: int = 1,
) -> DataFrame:
    """Clusters of core points linked within ``eps``; other rows are left out.

    A core row has at least ``min_samples`` rows (itself included) within eps. Copies of
    a position are merged into one weighted position first. Positions are put in cells
    whose diagonal is eps: a cell that already holds min_samples is core without any
    pair, only positions of thin cells are counted by pairs (each position meets at most
    those of the cells around it, fewer than min_samples a cell), and cells are linked by
    ``linked_cells``. The component search runs on cells, not rows. With min_samples = 2 this is
    plain DBSCAN. Output: by, row id, cluster_id (smallest row id of the cluster).
    """
    by = list(by)
    side = eps / len(coords) ** 0.5
    cells = [f"_s{i}" for i in range(len(coords))]
    spots = rows.groupBy(*by, *coords).agg(F.count(F.lit(1)).alias("_w"), F.min(row_id).alias("_p"))
    spots = spots.withColumns({k: cell(F.col(c), side) for k, c in zip(cells, coords)})
    spots = cut_lineage(spots)
    per_cell = spots.groupBy(*by, *cells).agg(F.sum("_w").alias("_cw"))
    spots = cut_lineage(spots.join(per_cell, [*by, *cells]))
    thin = spots.filter(F.col("_cw") < min_samples).select(*by, *coords, "_p")
    hits = radius_pairs(spots.select(*by, *coords, "_w"), thin, eps, coords, by)
    thin_core = hits.groupBy(*by, F.col("near._p").alias("_p")).agg(F.sum("_w").alias("_n")).filter(F.col("_n") >= min_samples)
    core = spots.filter(F.col("_cw") >= min_samples).unionByName(
        spots.filter(F.col("_cw") < min_samples).join(thin_core.select(*by, "_p"), [*by, "_p"], "left_semi").select(*spots.columns)
    )
    rep = core.groupBy(*by, *cells).agg(F.min("_p").alias("_rep"))
    core = cut_lineage(core.join(rep, [*by, *cells]).select(*by, *coords, "_p", "_w", "_rep"))
    links = linked_cells(core.select(*by, *coords, "_rep"), eps, side, coords, by)
    comp = connected_components(links, by).withColumnRenamed("node", "_rep")
    named = core.join(comp, [*by, "_rep"], "left").select(*by, *coords, "_w", F.coalesce("component", "_rep").alias("cluster_id"))
    sizes = named.groupBy(*by, "cluster_id").agg(F.sum("_w").alias("_n")).filter(F.col("_n") >= max(min_size, 2 if min_samples == 2 else 1))
    named = named.join(sizes.select(*by, "cluster_id"), [*by, "cluster_id"], "left_semi").drop("_w")
    return rows.select(*by, row_id, *coords).join(named, [*by, *coords]).select(*by, row_id, "cluster_id")
