"""Exact nearest neighbours: chunks of right rows, searched in tasks, and a second look only where a ball leaves its chunk.

1. Groups of right rows that are too large for a task become a tree of cells (``celltree``): cells are
   counted by an aggregate per round, crowded ones are split in the next round, small neighbours are
   joined into a chunk of at most ``CHUNK_ROWS`` rows. Small groups share chunks.
2. Every left row goes to one chunk that holds enough right rows near it. Left and right rows of a chunk
   meet once, as a cogroup; a chunk with many left rows is dealt to several tasks. The search halves
   blocks of left rows and drops the right rows that a block's box rules out.
3. The distance of the k-th neighbour found bounds a row's search. Only rows whose ball reaches other
   chunks go to those, with that bound, and their lists are merged.

Every row is shuffled once or twice as it is, its neighbours once as one list, whatever the density. The tree has
at most a few entries per ``MOST_CHUNKS``; it is the only thing that passes the driver. Ties are by id.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arborframe.lineage import cut_lineage, release
from arborframe.operators.celltree import NONE, Tree, search
from arborframe.operators.spatial import XYZ, one_per_position

#: Right rows of a chunk, and at least so many times the neighbours wanted; chunks grow when there would be more than the most.
CHUNK_ROWS, CHUNK_TIMES, MOST_CHUNKS = 4096, 64, 20_000
#: Left rows that a task searches a chunk for at once.
LEFT_ROWS = 50_000
#: Right rows, in groups that need no tree, that go to every task as they are; left rows then stay where they are.
FEW_ROWS = 50_000
#: Rounds of splitting.
DEEPEST = 20


class Boxes:
    """Column expressions over boxes ``{side}_lo{i}``, ``{side}_hi{i}`` of d coordinates."""

    def __init__(self, coords: Sequence[str]) -> None:
        self.coords, self.d = list(coords), len(coords)

    def of(self, side: str) -> list[str]:
        return [f"{side}_{e}{i}" for i in range(self.d) for e in ("lo", "hi")]

    def around(self, side: str) -> list[Column]:
        return [f(F.col(c)).alias(f"{side}_{e}{i}") for i, c in enumerate(self.coords) for e, f in (("lo", F.min), ("hi", F.max))]

    @staticmethod
    def norm(parts: Sequence[Column]) -> Column:
        return F.sqrt(reduce(lambda a, b: a + b, [p * p for p in parts]))

    def least(self, a: str, b: str) -> Column:
        return self.norm([F.greatest(F.col(f"{b}_lo{i}") - F.col(f"{a}_hi{i}"), F.col(f"{a}_lo{i}") - F.col(f"{b}_hi{i}"), F.lit(0.0)) for i in range(self.d)])

    def greatest(self, a: str, b: str) -> Column:
        return self.norm([F.greatest(F.col(f"{b}_hi{i}") - F.col(f"{a}_lo{i}"), F.col(f"{a}_hi{i}") - F.col(f"{b}_lo{i}")) for i in range(self.d)])


def grown(right: DataFrame, groups: DataFrame, by: Sequence[str], at: Sequence[str], most: int, need: int) -> tuple[Tree, DataFrame]:
    """The tree of the groups with more than ``most`` rows, and (by, _group, _n, _root) of all groups."""
    d = len(at)
    tree = Tree(d, most, need)
    large = groups.filter(F.col("_n") > most).select("_group", *[f"_lo{i}" for i in range(d)], *[f"_hi{i}" for i in range(d)]).toPandas()
    lo, hi = large[[f"_lo{i}" for i in range(d)]].to_numpy(float), large[[f"_hi{i}" for i in range(d)]].to_numpy(float)
    width = np.maximum((hi - lo).max(axis=1, initial=0.0), np.finfo(float).tiny)
    tree.add(lo, width, np.zeros(len(large), np.int64))
    spark = right.sparkSession
    roots = spark.createDataFrame(pd.DataFrame({"_group": large["_group"].astype("int64"), "_root": np.arange(len(large))}), "_group long, _root long")
    groups = cut_lineage(groups.join(roots, "_group", "left").select(*by, "_group", "_n", F.coalesce("_root", F.lit(NONE)).alias("_root")))
    rows = right.join(groups.filter("_root >= 0"), list(by))
    while len(large):  # ends: every round splits crowded cells, at most DEEPEST times
        open_cell = located(tree, 1)("_root", *at).alias("_cell")
        counted = rows.select(open_cell, *at).filter(f"_cell <> {NONE}").groupBy("_cell").agg(
            F.count(F.lit(1)).alias("n"), *[F.min(c).alias(f"lo{i}") for i, c in enumerate(at)], *[F.max(c).alias(f"hi{i}") for i, c in enumerate(at)]
        ).toPandas()
        boxes = [counted[[f"{e}{i}" for i in range(d)]].to_numpy(float) for e in ("lo", "hi")]
        if not tree.split(counted["_cell"].to_numpy(np.int64), counted["n"].to_numpy(np.int64), *boxes, DEEPEST):
            break
    return tree.close(), groups


def located(tree: Tree, which: int) -> Callable:
    """Column of the chunks (0) or of the open cells (1) of right rows; ``NONE`` for rows of groups without a tree and of the other kind."""

    @F.pandas_udf("long")
    def place(root: pd.Series, *at: pd.Series) -> pd.Series:
        out = np.full(len(root), NONE, np.int64)
        live = np.flatnonzero(root.to_numpy() >= 0)
        chunk, cell = tree.located(root.to_numpy(np.int64)[live], np.column_stack([c.to_numpy(float)[live] for c in at]))
        out[live] = np.where(chunk == NONE, cell, NONE) if which else chunk
        return pd.Series(out)

    return place


def home(tree: Tree) -> Callable:
    @F.pandas_udf("long")
    def place(root: pd.Series, *at: pd.Series) -> pd.Series:
        out = np.full(len(root), NONE, np.int64)
        live = np.flatnonzero(root.to_numpy() >= 0)
        if len(live):
            out[live] = tree.home(root.to_numpy(np.int64)[live], np.column_stack([c.to_numpy(float)[live] for c in at]))
        return pd.Series(out)

    return place


def lists_of(rows: pa.Table, at: np.ndarray, size: int, columns: Sequence[str]) -> list[pa.Array]:
    """Rows ``at`` of the columns as ``len(size)`` lists."""
    ends = pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32))
    return [pa.ListArray.from_arrays(ends, one_array(rows[c]).take(pa.array(at))) for c in columns]


def one_array(column: pa.ChunkedArray) -> pa.Array:
    return pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)


def numbers(rows: pa.Table, names: Sequence[str]) -> np.ndarray:
    return np.column_stack([one_array(rows[c]).to_numpy(zero_copy_only=False) for c in names])


def meeting(tree: Tree, d: int, k: int, kept: Sequence[str], lists: Sequence[str], schema: T.StructType, exclude_self: bool, last: bool, finish: Callable | None = None) -> Callable:
    """Search of the left rows of a chunk among its right rows; one row per left row with its lists.

    Unless it is the ``last`` search, rows whose ball leaves the chunk carry their bound and the other chunks. Where all neighbours
    of a row are found, ``finish`` may make a value of them, ``_done``, and the row has no lists.
    """
    at = [f"_x{i}" for i in range(d)]
    names = [f.name for f in schema.fields]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        m, n = left.num_rows, right.num_rows
        one, two = numbers(left, at), numbers(right, at)
        bound = one_array(left["_reach"]).to_numpy(zero_copy_only=False).astype(float)
        own = tuple(one_array(t["_self"]).to_numpy(zero_copy_only=False) for t in (left, right)) if exclude_self else None
        groups = [one_array(t["_group"]).to_numpy(zero_copy_only=False) for t in (left, right)]
        order = [np.argsort(g, kind="stable") for g in groups]
        sides = [np.unique(g[o], return_index=True) for g, o in zip(groups, order)]
        spans = [dict(zip(u.tolist(), zip(f.tolist(), [*f[1:].tolist(), len(o)]))) for (u, f), o in zip(sides, order)]
        found = []
        for group, (i0, i1) in spans[0].items() if n else ():
            if group in spans[1]:
                j0, j1 = spans[1][group]
                i, j = order[0][i0:i1], order[1][j0:j1]
                a, b, dist, bound[i] = search(one[i], two[j], k, bound[i], own and (own[0][i], own[1][j]))
                found.append((i[a], j[b], dist))
        a, b, dist = (np.concatenate([f[j] for f in found]) if found else np.zeros(0, np.int64 if j < 2 else float) for j in range(3))
        more, chunks = np.zeros(0, np.int64), np.zeros(0, np.int64)
        root = None if last else one_array(left["_root"]).to_numpy(zero_copy_only=False)
        if not last and m and (root >= 0).any():
            live = np.flatnonzero(root >= 0)
            place = one_array(left["_chunk"]).to_numpy(zero_copy_only=False)
            more, chunks = tree.others(root[live], one[live], bound[live], place[live])
            more = live[more]
        near, far = np.bincount(a, minlength=m), np.bincount(more, minlength=m)
        used = np.flatnonzero((near > 0) | (far > 0))
        out = {c: one_array(left[c]).take(pa.array(used)) for c in kept}
        if finish and not last:
            whole = (near > 0) & (far == 0) & ~one_array(left["_twice"]).to_numpy(zero_copy_only=False).astype(bool)
            mine = whole[a]
            done = finish(np.cumsum(whole)[a[mine]] - 1, right.select(list(lists)).take(pa.array(b[mine])), dist[mine], int(whole.sum()))
            if done is None:
                whole[:] = False
            else:
                a, b, dist, near = a[~mine], b[~mine], dist[~mine], np.where(whole, 0, near)
            value = np.zeros(m, np.int64)
            value[whole] = done if done is not None else 0
            out["_done"] = pa.array(value[used], mask=~whole[used])
        order = np.argsort(a, kind="stable")
        out["near_dist"] = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(near[used])]).astype(np.int32)), pa.array(dist[order]))
        out.update(zip(lists, lists_of(right, b[order], near[used], lists)))
        if not last:
            still = pa.array(np.where(far[used] > 0, used, 0), mask=far[used] == 0)
            out.update({c: one_array(left[c]).take(still) for c in (*at, "_group")})
            out["_reach"] = pa.array(bound[used], mask=far[used] == 0)
            out["_others"] = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(far[used])]).astype(np.int32)), pa.array(chunks[np.argsort(more, kind="stable")]))
            if exclude_self:
                out["_self"] = one_array(left["_self"]).take(still)
        return pa.table([out[c] for c in names], names=names)

    return run


def met(left: DataFrame, right: DataFrame, run: Callable, schema: T.StructType) -> DataFrame:
    """Left and right rows of every chunk, dealt to tasks of at most ``LEFT_ROWS`` left rows."""
    shares = cut_lineage(left.groupBy("_chunk").agg(F.ceil(F.count(F.lit(1)) / LEFT_ROWS).cast("int").alias("_shares")))
    left = left.join(shares.filter("_shares > 1"), "_chunk", "left").withColumn("_share", F.pmod(F.monotonically_increasing_id(), F.coalesce("_shares", F.lit(1))).cast("int"))
    right = right.join(shares, "_chunk").withColumn("_share", F.explode(F.sequence(F.lit(0), F.col("_shares") - 1)))
    key = ["_chunk", "_share"]
    return left.drop("_shares").groupBy(*key).cogroup(right.drop("_shares").groupBy(*key)).applyInArrow(run, schema)


def neighbour_lists(
    left: DataFrame, right: DataFrame, k: int, left_id: str, right_id: str, coords: Sequence[str], by: Sequence[str], within: float | None, take: Sequence[str], exclude_self: bool = False, finish: Callable | None = None
) -> tuple[DataFrame, ...] | None:
    """Rows (by, left id, near_dist, near_id, _t_ of ``take``) with the k nearest of a left row and all rows as near as the k-th, as lists.

    In the first table the list of a left row is whole; in the second one a left row has several lists, which
    together are. ``left`` and ``right`` are written tables with rows of known coordinates; None when either is empty.
    With ``finish`` (as in ``meeting``) there is a third table (by, left id, _done) of the rows it has made a value of, which are in no other.
    """
    by, d = list(by), len(coords)
    at, taken = [f"_x{i}" for i in range(d)], [f"_t_{c}" for c in take]
    placed = [F.col(c).cast("double").alias(x) for c, x in zip(coords, at)]
    whole = right.select(*by, *placed).groupBy(*by).agg(F.count(F.lit(1)).alias("_n"), *[f(x).alias(f"_{n}{i}") for i, x in enumerate(at) for f, n in ((F.min, "lo"), (F.max, "hi"))])
    groups = cut_lineage(whole.withColumn("_group", F.monotonically_increasing_id()))
    n_right = groups.agg(F.sum("_n")).first()[0]
    n_left = left.count()
    if not n_right or not n_left:
        return None
    wanted = k + 1 if exclude_self else k
    most = max(CHUNK_ROWS, CHUNK_TIMES * wanted, -(-n_right // MOST_CHUNKS))
    key = [F.xxhash64(c).alias("_self") for c in (left_id,)] if exclude_self else []
    there = right.select(*by, F.col(right_id).alias("near_id"), *placed, *[F.col(c).alias(f"_t_{c}") for c in take], *([F.xxhash64(right_id).alias("_self")] if exclude_self else []))
    tree, groups = grown(there, groups, by, at, most, wanted)
    # small groups share chunks, which are numbered after those of the tree
    shared = F.lit(tree.chunks) + F.pmod(F.xxhash64("_group"), F.lit(max(1, n_right // most)))
    chunk = lambda place: F.when(F.col("_root") >= 0, place).otherwise(shared).alias("_chunk")
    there = there.join(groups.drop("_n"), by)
    there = cut_lineage(there.select("near_id", *at, *taken, *(["_self"] if exclude_self else []), "_group", chunk(located(tree, 0)("_root", *at))))
    here = left.select(*by, left_id, *placed, *key).join(groups.drop("_n"), by)
    here = here.select("*", F.lit(float("inf") if within is None else float(within)).alias("_reach"), chunk(home(tree)("_root", *at)))
    # lists of left rows that repeat an id are one list
    kept, lists = [*by, left_id], ["near_id", *taken]
    twice = cut_lineage(left.groupBy(*kept).agg(F.count(F.lit(1)).alias("_m")).filter("_m > 1").select(*kept, F.lit(True).alias("_twice")))
    repeats = not twice.isEmpty()
    if finish:
        here = here.join(twice, kept, "left").withColumn("_twice", F.coalesce("_twice", F.lit(False))) if repeats else here.withColumn("_twice", F.lit(False))
    few = not tree.chunks and n_right <= FEW_ROWS
    here = here if few else cut_lineage(here)

    types = {**{f.name: f.dataType for f in here.schema.fields}, **{f.name: f.dataType for f in there.schema.fields}}
    plain = [T.StructField(c, types[c]) for c in kept] + [T.StructField(c, T.ArrayType(t)) for c, t in [("near_dist", T.DoubleType()), *[(c, types[c]) for c in lists]]]
    again = [T.StructField(c, types[c]) for c in (*at, "_group", "_reach", *(["_self"] if exclude_self else []))] + [T.StructField("_others", T.ArrayType(T.LongType()))]
    made = [T.StructField("_done", T.LongType())] if finish else []
    first, second = T.StructType(plain + made + again), T.StructType(plain)
    run = meeting(tree, d, k, kept, lists, first, exclude_self, False, finish)
    if few:
        everywhere = there.toArrow()

        def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: list[pa.RecordBatch] = []
            for batch in itertools.chain(batches, [None]):
                if held and (batch is None or sum(map(len, held)) >= LEFT_ROWS):
                    yield from run(pa.Table.from_batches(held), everywhere).to_batches()
                    held = []
                held += [] if batch is None else [batch]

        found = cut_lineage(here.mapInArrow(each, first))
    else:
        found = cut_lineage(met(here, there, run, first))
        release(here)
    done = []
    if finish:
        done = [found.filter("_done IS NOT NULL").select(*kept, "_done")]
        found = found.filter("_done IS NULL").drop("_done")

    if repeats:
        found = found.join(twice, kept, "left")
    else:
        found = found.withColumn("_twice", F.lit(None).cast("boolean"))
    names = [*kept, "near_dist", *lists]
    alone = F.col("_twice").isNull() & (F.size("_others") == 0)
    if not tree.chunks:
        return found.filter(alone).select(*names), found.filter(~alone).select(*names), *done
    leaving = found.filter(F.size("_others") > 0).select("*", F.explode("_others").alias("_chunk")).drop("_others", "_twice", "near_dist", *lists)
    beyond = cut_lineage(met(cut_lineage(leaving), there, meeting(tree, d, k, kept, lists, second, exclude_self, True), second))
    return found.filter(alone).select(*names), found.filter(~alone).select(*names).unionByName(beyond), *done


def with_neighbourhood(rows: DataFrame, reach: float, coords: Sequence[str] = XYZ, by: Sequence[str] = ("plot_id",), most: int | None = None) -> tuple[DataFrame, int] | None:
    """The rows with ``_group``, ``_chunk`` and ``_own``: each in its chunk, and a copy (not ``_own``) in every other chunk within ``reach``; and the rows of the largest chunk.

    So a chunk has all rows within reach of its own ones, and work on pairs can be done in it without a pair being
    written or shuffled. ``rows`` are read several times, and are rows of a known group and of known coordinates; None when there are none.
    """
    by, d = list(by), len(coords)
    at = [f"_x{i}" for i in range(d)]
    placed = rows.withColumns({x: F.col(c).cast("double") for c, x in zip(coords, at)})
    whole = placed.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"), *[f(x).alias(f"_{n}{i}") for i, x in enumerate(at) for f, n in ((F.min, "lo"), (F.max, "hi"))])
    groups = cut_lineage(whole.withColumn("_group", F.monotonically_increasing_id()))
    n_rows = groups.agg(F.sum("_n")).first()[0]
    if not n_rows:
        return None
    most = max(most or CHUNK_ROWS, -(-n_rows // MOST_CHUNKS))
    tree, groups = grown(placed, groups, by, at, most, 1)
    shared = F.lit(tree.chunks) + F.pmod(F.xxhash64("_group"), F.lit(max(1, n_rows // most)))

    @F.arrow_udf("array<long>")
    def places(root: pa.Array, *at: pa.Array) -> pa.Array:
        root, x = root.to_numpy(zero_copy_only=False), np.column_stack([c.to_numpy(zero_copy_only=False) for c in at])
        live = np.flatnonzero(root >= 0)
        chunk = np.full(len(root), NONE, np.int64)
        chunk[live] = tree.located(root[live], x[live])[0]
        row, other = tree.others(root[live], x[live], np.full(len(live), float(reach)), chunk[live]) if len(live) else (live, live)
        row = np.concatenate([np.arange(len(root)), live[row]])
        order = np.argsort(row, kind="stable")  # the own chunk first
        ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(root)))]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([chunk, other])[order]))

    out = placed.join(groups.drop("_n"), by).select(*rows.columns, "_group", "_root", *at)
    out = out.select(*rows.columns, "_group", "_root", F.posexplode(places("_root", *at)).alias("_place", "_chunk"))
    out = out.select(*rows.columns, "_group", F.when(F.col("_root") >= 0, F.col("_chunk")).otherwise(shared).alias("_chunk"), (F.col("_place") == 0).alias("_own"))
    return out, max([most, *tree.rows[tree.to < 0].astype(int).tolist()])


def spans(group: np.ndarray) -> list[np.ndarray]:
    """Places of each value's rows."""
    order = np.argsort(group, kind="stable")
    return np.split(order, np.flatnonzero(np.diff(group[order])) + 1) if len(group) else []


def as_rows(lists: DataFrame, names: Sequence[str], take: Sequence[str]) -> DataFrame:
    rows = lists.select(*names, F.explode(F.arrays_zip("near_dist", "near_id", *[f"_t_{c}" for c in take])).alias("_near"))
    return rows.select(*names, "_near.near_id", "_near.near_dist", *[F.col(f"_near._t_{c}").alias(c) for c in take])


def candidates(
    left: DataFrame, right: DataFrame, k: int, left_id: str, right_id: str, coords: Sequence[str], by: Sequence[str], within: float | None, take: Sequence[str]
) -> DataFrame | None:
    """(by, left id, near_id, near_dist, take): right rows among which are the k nearest of every left row, and all rows as near as the k-th.

    ``left`` and ``right`` are written tables with rows of known coordinates; None when either is empty.
    """
    found = neighbour_lists(left, right, k, left_id, right_id, coords, by, within, take)
    if found is None:
        return None
    whole, parts = (as_rows(lists, [*by, left_id], take) for lists in found)
    by_distance = Window.partitionBy(*by, left_id).orderBy("near_dist")
    return whole.unionByName(parts.withColumn("_r", F.rank().over(by_distance)).filter(F.col("_r") <= k).drop("_r"))


def prepared(left: DataFrame, right: DataFrame, k: int, left_id: str, right_id: str, coords: Sequence[str], by: Sequence[str], take: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Both sides written, without rows of unknown coordinates; of the copies of a position the k first ids."""
    known = reduce(lambda a, b: a & b, [F.abs(F.col(c).cast("double")) < float("inf") for c in coords])
    right = right.select(*dict.fromkeys([*by, right_id, *coords, *take])).filter(known)
    return cut_lineage(left.select(*by, left_id, *coords).filter(known)), cut_lineage(one_per_position(right, coords, by, right_id, k))


def nearest_rows(
    left: DataFrame,
    right: DataFrame,
    k: int,
    left_id: str,
    right_id: str,
    coords: Sequence[str] = XYZ,
    by: Sequence[str] = ("plot_id",),
    within: float | None = None,
    exclude_self: bool = False,
    take: Sequence[str] = (),
    finish: Callable | None = None,
) -> DataFrame | tuple[DataFrame, DataFrame]:
    """The k nearest right rows of every left row, at most ``within`` away, ties by right id.

    Output: by, left id, near_id, near_dist, rank and the right columns in ``take``. A left row
    gets fewer than k rows only if its group (or the distance) has fewer. Rows with an unknown
    coordinate have and are no neighbours. With ``finish`` (as in ``meeting``) the left rows that it made a value of
    are not in it but in a second table (by, left id, _done).
    """
    by, take = list(by), list(take)
    names, taken = [*by, left_id], [f"_t_{c}" for c in take]
    a, b = prepared(left, right, k + 1 if exclude_self else k, left_id, right_id, coords, by, take)
    found = neighbour_lists(a, b, k, left_id, right_id, coords, by, within, take, exclude_self, finish)
    if found is None:
        none = a.join(b.select(*by, F.col(right_id).alias("near_id"), F.lit(0.0).alias("near_dist"), *[F.col(c).alias(t) for c, t in zip(take, taken)]), by).filter("false")
        none = none.select(*names, "near_id", "near_dist", F.lit(1).alias("rank"), *[F.col(t).alias(c) for c, t in zip(take, taken)])
        return (none, none.select(*names, F.lit(0).cast("long").alias("_done"))) if finish else none
    whole, parts, *done = found
    # a whole list is ranked where it is; only lists in parts are shuffled
    near = F.array_sort(F.arrays_zip("near_dist", "near_id", *taken))
    if exclude_self:
        near = F.filter(near, lambda n: n["near_id"] != F.col(left_id))
    whole = whole.select(*names, F.posexplode(F.slice(near, 1, k)).alias("_i", "_near"))
    whole = whole.select(*names, "_near.near_id", "_near.near_dist", (F.col("_i") + 1).alias("rank"), *[F.col(f"_near.{t}").alias(c) for c, t in zip(take, taken)])
    parts = as_rows(parts, names, take)
    if exclude_self:
        parts = parts.filter(F.col(left_id) != F.col("near_id"))
    nth = Window.partitionBy(*names).orderBy("near_dist", "near_id", *take)
    parts = parts.withColumn("rank", F.row_number().over(nth)).filter(F.col("rank") <= k)
    near = whole.unionByName(parts.select(*whole.columns)).select(*names, "near_id", "near_dist", "rank", *take)
    return (near, done[0]) if finish else near


def nearest_within(
    left: DataFrame, right: DataFrame, radius: float, left_id: str, right_id: str, coords: Sequence[str] = XYZ, by: Sequence[str] = ("plot_id",), take: Sequence[str] = ()
) -> DataFrame:
    """The left rows with ``near_id``, ``near_dist`` and ``take`` of the nearest right row within ``radius`` (null when none)."""
    key = [*by, left_id]
    found = nearest_rows(left, right, 1, left_id, right_id, coords, by, radius, take=take)
    found = found.select(*key, F.struct("near_id", "near_dist", *[F.col(c).alias(f"_t_{c}") for c in take]).alias("_best"))
    return left.join(found, key, "left").select(*left.columns, "_best.near_id", "_best.near_dist", *[F.col(f"_best._t_{c}").alias(c) for c in take])
