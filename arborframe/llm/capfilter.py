"""Near-duplicate vectors by spherical-cap filters.

Filter directions form a structured random product code: the dimensions are split into
blocks, each block has its own random unit code words, and a direction joins one word per
block. A vector belongs to every filter whose direction it exceeds the threshold with. These
are list-decoded: only first words that can still reach the threshold with the best of the
other block are opened. Vectors meet in common filters and every met pair is verified by its
cosine in double precision; a pair counts in its least common filter only.

The number of code words grows with the number of vectors so that a vector meets about
``meetings`` unrelated ones, whatever the table's size. The threshold gives a random vector
``lists`` filters on average; a pair at cosine 0.95 then shares about 0.6 * lists, so with the
default few such pairs are missed; vectors that exceed fewer than ``FEWEST`` directions take
their nearest ones. A filter held by many vectors is split into
blocks, and block pairs are verified in separate tasks: nothing is capped.

Defined results: vectors that are null, empty, zero, hold null or non-finite components, or
have another length than most vectors link with nothing, and so do rows without an id; equal
vectors are verified once and link with each other; rows that repeat an id are one node of
the components; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arborframe.lineage import cut_lineage
from arborframe.operators.graph import connected_components

LEAST, LISTS, MEETINGS, SEED = 0.95, 20.0, 150.0, 7
#: A vector beyond the reach of most directions still takes this many nearest filters.
FEWEST = 16
#: Members of a filter that one task compares; more are split into pairs of blocks.
BLOCK = 2000


def code(dims: int, words: int, seed: int = SEED) -> list[np.ndarray]:
    """Two blocks of unit code words (words x half of the dimensions)."""
    rng = np.random.default_rng([seed, dims, words])
    halves = [rng.standard_normal((words, d)) for d in (dims // 2, dims - dims // 2)]
    return [h / np.maximum(np.linalg.norm(h, axis=1, keepdims=True), 1e-12) for h in halves]


def threshold(words: list[np.ndarray], lists: float, seed: int = SEED) -> float:
    """The inner product that ``lists`` directions exceed for a random vector, by simulation."""
    dims = sum(w.shape[1] for w in words)
    x = np.random.default_rng([seed, dims]).standard_normal((400, dims))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    cut = words[0].shape[1]
    a, b = np.sort(x[:, :cut] @ words[0].T, axis=1)[:, ::-1], np.sort(x[:, cut:] @ words[1].T, axis=1)[:, ::-1]
    top = min(96, a.shape[1])  # the directions in question join leading words
    sums = (a[:, :top, None] + b[:, None, :top]).ravel() / np.sqrt(2)
    wanted = min(int(lists * len(x)), len(sums) - 1)
    return float(-np.partition(-sums, wanted)[wanted])


def decode(x: np.ndarray, words: list[np.ndarray], least: float) -> list[np.ndarray]:
    """Per unit vector the numbers of all filters with inner product >= least, ascending."""
    cut, many, reach = words[0].shape[1], len(words[1]), least * np.sqrt(2)
    out: list[np.ndarray] = []
    for at in range(0, len(x), 512):
        a, b = x[at : at + 512, :cut] @ words[0].T, x[at : at + 512, cut:] @ words[1].T
        row, first = np.nonzero(a + b.max(axis=1, keepdims=True) >= reach)
        pairs: list[tuple[np.ndarray, np.ndarray]] = []
        for lo in range(0, len(row), 4096):
            r, f = row[lo : lo + 4096], first[lo : lo + 4096]
            k, second = np.nonzero(b[r] + a[r, f][:, None] >= reach)
            pairs.append((r[k], f[k].astype(np.int64) * many + second))
        rows = np.concatenate([p[0] for p in pairs]) if pairs else np.zeros(0, int)
        found = np.concatenate([p[1] for p in pairs]) if pairs else np.zeros(0, np.int64)
        ends = np.searchsorted(rows, np.arange(len(a) + 1))
        out += [np.sort(found[ends[i] : ends[i + 1]]) for i in range(len(a))]
    return out


def nearest(x: np.ndarray, words: list[np.ndarray], fewest: int) -> list[np.ndarray]:
    """Per unit vector the ``fewest`` filters of largest inner product, ascending by number."""
    cut, many = words[0].shape[1], len(words[1])
    a, b = x[:, :cut] @ words[0].T, x[:, cut:] @ words[1].T
    k = min(fewest, a.shape[1], many)  # the best sums join the best k words of each block
    first, second = np.argsort(-a, axis=1, kind="stable")[:, :k], np.argsort(-b, axis=1, kind="stable")[:, :k]
    sums = np.take_along_axis(a, first, 1)[:, :, None] + np.take_along_axis(b, second, 1)[:, None, :]
    best = np.argsort(-sums.reshape(len(x), -1), axis=1, kind="stable")[:, :fewest]
    numbers = (first.astype(np.int64)[:, :, None] * many + second[:, None, :]).reshape(len(x), -1)
    return list(np.sort(np.take_along_axis(numbers, best, 1), axis=1))


def pairs_in(x: np.ndarray, side: np.ndarray, cross: bool, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs i < j (or of different sides) with cosine >= least, in double precision."""
    norm = np.sqrt((x * x).sum(axis=1))
    out = []
    for at in range(0, len(x), 256):
        cosine = (x[at : at + 256] @ x.T) / (norm[at : at + 256, None] * norm[None, :])
        i, j = np.nonzero(cosine >= least)
        i += at
        keep = (i < j) & ((side[i] != side[j]) if cross else True)
        out.append((i[keep], j[keep]))
    return np.concatenate([o[0] for o in out]), np.concatenate([o[1] for o in out])


def counted_here(lists: list[np.ndarray], own: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether ``own`` is the least filter common to each pair."""
    earlier = [np.asarray(f)[np.asarray(f) < own] for f in lists]
    width = max((len(e) for e in earlier), default=0)
    if not width:
        return np.ones(len(i), dtype=bool)
    a, b = np.full((len(lists), width), -1, dtype=np.int64), np.full((len(lists), width), -2, dtype=np.int64)
    for k, e in enumerate(earlier):
        a[k, : len(e)] = b[k, : len(e)] = e
    out = np.empty(len(i), dtype=bool)
    for at in range(0, len(i), 8192):
        s = slice(at, at + 8192)
        out[s] = ~(a[i[s]][:, :, None] == b[j[s]][:, None, :]).any(axis=(1, 2))
    return out


def local_roots(ids: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Least id reachable through the pairs, per row."""
    root = ids.copy()
    while len(i):
        low = np.minimum(root[i], root[j])
        before = root.copy()
        np.minimum.at(root, i, low)
        np.minimum.at(root, j, low)
        if (root == before).all():
            break
    return root


def compare(group: pd.DataFrame, least: float) -> pd.DataFrame:
    """(row, links, root) of the members of one cell that have a link there."""
    group = group.sort_values("row", kind="stable")
    x = np.stack(group["vector"].to_numpy()).astype(np.float64)
    cross = bool(group["low"].iloc[0] != group["high"].iloc[0])
    i, j = pairs_in(x, group["block"].to_numpy(), cross, least)
    if not len(i):
        return pd.DataFrame({"row": [], "links": [], "root": []})
    here = counted_here(list(group["filters"]), int(group["filter"].iloc[0]), i, j)
    weight, links = group["weight"].to_numpy(np.int64), np.zeros(len(group), dtype=np.int64)
    np.add.at(links, i[here], weight[j[here]])
    np.add.at(links, j[here], weight[i[here]])
    rows = group["row"].to_numpy(np.int64)
    touched = np.unique(np.concatenate([i, j]))
    return pd.DataFrame({"row": rows[touched], "links": links[touched], "root": local_roots(rows, i, j)[touched]})


def distinct_vectors(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(members, distinct): members(vec_id, h1, h2), h1 null where a vector links with nothing,
    and distinct(row, h1, h2, vector, weight)."""
    v = F.col("embedding")
    length = vectors.filter(F.size(v) > 0).groupBy(F.size(v).alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").first()
    dims = length["d"] if length else 0
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    sound = F.col("vec_id").isNotNull() & (F.size(v) == dims) & finite & F.exists(v, lambda c: c != 0)
    sound = F.coalesce(sound, F.lit(False))
    hashed = vectors.select("vec_id", F.when(sound, v).alias("vector"))
    hashed = hashed.withColumns({"h1": F.when(F.col("vector").isNotNull(), F.xxhash64("vector")), "h2": F.when(F.col("vector").isNotNull(), F.xxhash64(F.lit(1), "vector"))})
    distinct = hashed.filter("h1 is not null").groupBy("h1", "h2").agg(F.first("vector").alias("vector"), F.count(F.lit(1)).alias("weight"), F.min("vec_id").alias("least_id"))
    return hashed.select("vec_id", "h1", "h2"), cut_lineage(distinct.withColumn("row", F.monotonically_increasing_id()))


def filtered(distinct: DataFrame, lists: float, meetings: float) -> DataFrame:
    """(row, weight, vector, filters) with the filters of every distinct vector."""
    n = distinct.count()
    sample = distinct.first()
    dims = len(sample["vector"]) if sample else 1
    words = code(dims, max(16, int(np.ceil(np.sqrt(n * lists * lists / meetings)))))
    least = threshold(words, lists)

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                x = np.stack(batch["vector"].to_numpy()).astype(np.float64)
                x /= np.abs(x).max(axis=1, keepdims=True)
                x /= np.linalg.norm(x, axis=1, keepdims=True)
                found = decode(x, words, least)
                thin = [i for i, f in enumerate(found) if len(f) < FEWEST]
                for i, f in zip(thin, nearest(x[thin], words, FEWEST) if thin else []):
                    found[i] = f
                yield batch.assign(filters=found)

    kind = distinct.schema["vector"].dataType.simpleString()
    return distinct.select("row", "weight", "vector").mapInPandas(find, f"row long, weight long, vector {kind}, filters array<long>")


def links(distinct: DataFrame, least: float = LEAST, lists: float = LISTS, meetings: float = MEETINGS, block: int = BLOCK) -> DataFrame:
    """(row, links, root) per cell of a filter: a vector's links counted there and a linked root."""
    members = cut_lineage(filtered(distinct, lists, meetings))
    rows = members.select("*", F.explode("filters").alias("filter"))
    crowded = rows.groupBy("filter").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > block)
    crowded = cut_lineage(crowded.select(F.col("filter").alias("_f"), F.ceil(F.col("n") / block).cast("int").alias("blocks")))
    rows = rows.join(crowded, F.col("filter") == F.col("_f"), "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})
    cells = rows.select("row", "weight", "vector", "filters", "filter", "block", "low", "high")
    cells = cells.repartition("filter", "low", "high").sortWithinPartitions("filter", "low", "high")

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: pd.DataFrame | None = None
        for batch in batches:
            batch = batch if held is None else pd.concat([held, batch], ignore_index=True)
            key = batch[["filter", "low", "high"]].to_numpy()
            ends = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
            starts = np.concatenate([[0], ends])
            done = [compare(batch.iloc[a:b], least) for a, b in zip(starts[:-1], starts[1:]) if b - a > 1]
            held = batch.iloc[starts[-1] :]
            if done:
                yield pd.concat(done, ignore_index=True).astype("int64")
        if held is not None and len(held) > 1:
            yield compare(held, least).astype("int64")

    return cells.mapInPandas(walk, "row long, links long, root long")


def near_duplicates(vectors: DataFrame, least: float = LEAST, lists: float = LISTS, meetings: float = MEETINGS, block: int = BLOCK) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row of vectors(vec_id, embedding)."""
    members, distinct = distinct_vectors(vectors)
    found = cut_lineage(links(distinct, least, lists, meetings, block).groupBy("row").agg(F.sum("links").alias("links"), F.collect_set("root").alias("roots")))
    names = distinct.select("row", F.col("least_id").alias("node"))
    edges = found.select("row", F.explode("roots").alias("root")).filter("row <> root").join(names, "row")
    edges = edges.select("node", F.col("root").alias("row")).join(names.withColumnRenamed("node", "v"), "row").select(F.col("node").alias("u"), "v")
    # a repeated id stands for all its vectors, so its least ids are linked to it as well
    keyed = members.filter("h1 is not null").join(distinct.select("h1", "h2", "row", "weight", "least_id"), ["h1", "h2"])
    keyed = cut_lineage(keyed.join(found.select("row", "links"), "row", "left").select("vec_id", "h1", "h2", "weight", "least_id", "links"))
    same = keyed.filter("vec_id <> least_id").select(F.col("vec_id").alias("u"), F.col("least_id").alias("v"))
    component = connected_components(edges.unionByName(same), by=()).withColumnRenamed("node", "vec_id")
    sound = keyed.join(component, "vec_id", "left").select(
        "vec_id", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).cast("long").alias("n_links"), F.coalesce("component", "vec_id").alias("component_id")
    )
    alone = members.filter("h1 is null").join(component, "vec_id", "left").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"))
    out = sound.unionByName(alone)
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
