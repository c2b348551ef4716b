"""Prefix trie of conversations by truncation peeling.

A node of depth d stands for all conversations whose first d turns are the same (role, text);
the root (d = 0) stands for all of them. The trie is found from its deepest turns upwards:
nodes of the deepest level and the conversations that end one level higher are regrouped by
the path without its last turn, and every regrouping yields both the next nodes and their
aggregates (members, children, leaves, saved characters), so no node is visited twice.

* A turn is known by a 128-bit hash, a path by the chained hash of its turns; texts are read
  once and never shuffled. A conversation's chain is computed over its sorted turns as a
  stream and stored in pieces of at most ``BLOCKS[-1]`` turns.
* Equal conversations collapse to their least id before the peeling.
* Levels are peeled in blocks, the deepest block first. Within a block, the rows that share
  the block's first turn are peeled in one task as long as they hold at most ``group_turns``
  turns; larger groups are peeled level by level as aggregates with a map-side part, so a
  first turn that a third of all conversations share is no group of one task. Both ways give
  the same rows. Rounds grow with the logarithm of the longest conversation where groups are small.
* The hash over the members that end in a node is sequential by definition. It is taken over a
  sorted stream, so a task keeps one hash state, not the list of members.

Defined results: rows without conv_id belong to no conversation; null role or text is empty;
turns of equal number are ordered by role and content; repeated rows are turns of their own;
a conversation without turns is a member of the root; an empty table has no root and gives no
rows; columns other than conv_id, turn, role and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arborframe.lineage import cut_lineage, release

#: Turns per block of levels, from the root downwards; the last size repeats.
BLOCKS = (16, 64, 256, 1024, 4096)
GROUP_TURNS = 200_000
KEY = 16
ROOT = b""
EMPTY_HASH = hashlib.sha256(b"").hexdigest()

CHAIN = "conv_id long, block int, top binary, n int, last boolean, keys binary, chars array<long>"
ENDED = "conv_id long, depth long, key binary, n_convs long, ends string"
NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends string"


def block_bounds(deepest: int) -> list[tuple[int, int]]:
    """(lo, hi) per block: it covers the depths lo + 1 to hi."""
    bounds, lo, k = [], 0, 0
    while lo < deepest:
        hi = lo + BLOCKS[min(k, len(BLOCKS) - 1)]
        bounds.append((lo, hi))
        lo, k = hi, k + 1
    return bounds


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, digest, chars): turns numbered from 1, as a hash of role and text and the text's code points."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    slim = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        role.alias("role"),
        F.substring(F.unhex(F.sha2(whole, 256)), 1, KEY).alias("digest"),
        F.length(text).cast("long").alias("chars"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "digest")
    return slim.select("conv_id", F.row_number().over(order).cast("long").alias("pos"), "digest", "chars")


def with_shared_heads(turns: DataFrame, family: int = 100, most: int = 5) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt on the head of their family's first one, as (turns, ids).

    Conversation c starts with the first h turns of conversation c - c % family (all if it has
    fewer, none if it is absent), h = crc32 of the decimal c modulo ``most`` + 1, and goes on
    with its own turns after the first h.
    """
    turn = F.struct("pos", "digest", "chars")
    kept = F.crc32(F.col("conv_id").cast("string")) % F.lit(most + 1)
    heads = turns.filter((F.col("conv_id") % family == 0) & (F.col("pos") <= most))
    heads = heads.groupBy(F.col("conv_id").alias("_base")).agg(F.sort_array(F.collect_list(turn)).alias("_head"))
    convs = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("_n")).select("conv_id", kept.alias("_h"))
    convs = convs.withColumn("_base", F.col("conv_id") - F.col("conv_id") % family).join(heads, "_base", "left")
    convs = convs.select("conv_id", "_h", F.expr("slice(coalesce(_head, array()), 1, cast(_h AS int))").alias("_head"))
    convs = cut_lineage(convs)
    first = convs.select("conv_id", F.explode("_head").alias("_t")).select("conv_id", "_t.*")
    shift = convs.select("conv_id", "_h", F.size("_head").alias("_m"))
    rest = turns.join(shift, "conv_id").filter("pos > _h").select("conv_id", (F.col("pos") - F.col("_h") + F.col("_m")).alias("pos"), "digest", "chars")
    return first.unionByName(rest), convs.select("conv_id")


def rows_of(batch: pa.RecordBatch) -> Iterator[tuple]:
    return zip(*(column.to_pylist() for column in batch.columns), strict=True)


def table_of(rows: list[tuple], types: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, types, strict=True)], [n for n, _ in types])


def chained(turns: DataFrame) -> DataFrame:
    """One row per conversation and block: the chained hashes and lengths of its turns there."""
    types = [("conv_id", pa.int64()), ("block", pa.int32()), ("top", pa.binary()), ("n", pa.int32()), ("last", pa.bool_()), ("keys", pa.binary()), ("chars", pa.list_(pa.int64()))]

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, key, block, keys, chars = None, ROOT, 0, [], []

        def piece(last: bool) -> tuple:
            return conv, block, keys[0], len(keys), last, b"".join(keys), chars

        for batch in batches:
            out = []
            for conv_id, digest, n_chars in rows_of(batch):
                if conv_id != conv:
                    if keys:
                        out.append(piece(True))
                    conv, key, block, keys, chars = conv_id, ROOT, 0, [], []
                elif len(keys) == BLOCKS[min(block, len(BLOCKS) - 1)]:
                    out.append(piece(False))
                    block, keys, chars = block + 1, [], []
                key = hashlib.blake2b(key + digest, digest_size=KEY).digest()
                keys.append(key)
                chars.append(n_chars)
            yield table_of(out, types)
        if keys:
            yield table_of([piece(True)], types)

    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "pos").select("conv_id", "digest", "chars")
    return ordered.mapInArrow(chain, CHAIN)


def ended(ends: DataFrame) -> DataFrame:
    """Equal conversations as one row: least id, number and the hash over their ids, from ends(key, depth, conv_id)."""
    types = [("conv_id", pa.int64()), ("depth", pa.int64()), ("key", pa.binary()), ("n_convs", pa.int64()), ("ends", pa.string())]

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, first, size, state = None, 0, 0, hashlib.sha256()
        for batch in batches:
            out = []
            for key, depth, conv_id in rows_of(batch):
                if (key, depth) != held:
                    if held is not None:
                        out.append((first, held[1], held[0], size, state.hexdigest()))
                    held, first, size, state = (key, depth), conv_id, 1, hashlib.sha256(b"%d" % conv_id)
                else:
                    size += 1
                    state.update(b",%d" % conv_id)
            yield table_of(out, types)
        if held is not None:
            yield table_of([(first, held[1], held[0], size, state.hexdigest())], types)

    return ends.select("key", "depth", "conv_id").repartition("key").sortWithinPartitions("key", "conv_id").mapInArrow(fold, ENDED)


class Node:
    """A node under construction: its members so far, its finished children, its path in the block."""

    __slots__ = ("conv", "n", "ends", "children", "keys", "chars")

    def __init__(self, conv: int, keys: bytes, chars: list[int]) -> None:
        self.conv, self.n, self.ends, self.children, self.keys, self.chars = conv, 0, None, [], keys, chars

    def join(self, conv: int, n: int) -> None:
        self.conv, self.n = min(self.conv, conv), self.n + n


def peel_group(rows: list[tuple], lo: int, hi: int) -> Iterator[tuple]:
    """The nodes at depths lo + 1 to hi + 1 of rows that share their turn lo + 1.

    rows: (conv, depth, n, children, leaves, saved, ends, keys, chars); a row at depth hi + 1 is a
    finished node of the block below, other rows are ended conversations. Yields the columns of
    NODE; the node at depth lo + 1 comes last, without its parent.
    """
    levels: list[dict[bytes, Node]] = [{} for _ in range(hi - lo + 1)]

    def at(depth: int, conv: int, keys: bytes, chars: list[int]) -> Node:
        key = keys[(depth - lo - 1) * KEY : (depth - lo) * KEY]
        level = levels[depth - lo]
        if key not in level:
            level[key] = Node(conv, keys, chars)
        return level[key]

    for conv, depth, n, children, leaves, saved, ends, keys, chars in rows:
        node = at(min(depth, hi), conv, keys, chars)
        node.join(conv, n)
        if depth > hi:
            node.children.append((conv, depth, n, children, leaves, saved, ends))
        else:
            node.ends = ends
    for depth in range(hi, lo, -1):
        for node in levels[depth - lo].values():
            leaves = sum(c[4] for c in node.children) or 1
            saved = sum(c[5] for c in node.children) + (node.n - 1) * node.chars[depth - lo - 1]
            for c in node.children:
                yield c[0], c[1], node.conv, *c[2:]
            done = (node.conv, depth, node.n, len(node.children), leaves, saved, node.ends)
            if depth - 1 == lo:
                yield done[0], done[1], None, *done[2:]
            else:
                parent = at(depth - 1, node.conv, node.keys, node.chars)
                parent.join(node.conv, node.n)
                parent.children.append(done)


def peel_in_tasks(rows: DataFrame, lo: int, hi: int) -> DataFrame:
    """``peel_group`` over the groups of equal ``top``; nodes whose parent lies above the block have a null parent."""
    types = [(n, pa.string() if n == "ends" else pa.int64()) for n in (c.split()[0] for c in NODE.split(", "))]

    def peel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, group = None, []
        for batch in batches:
            out = []
            for top, *row in rows_of(batch):
                if top != held:
                    out += peel_group(group, lo, hi)
                    held, group = top, []
                group.append(tuple(row))
            yield table_of(out, types)
        yield table_of(list(peel_group(group, lo, hi)), types)

    order = ("top", "conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends", "keys", "chars")
    return rows.select(*order).repartition("top").sortWithinPartitions("top").mapInArrow(peel, NODE)


def peel_by_levels(rows: DataFrame, lo: int, hi: int) -> list[DataFrame]:
    """The same for groups of any size: one aggregate per level, written before the next one reads it."""
    own = ["conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends"]
    path = ["keys", "chars"]
    rows = cut_lineage(rows.select(*own, *path))
    front = rows.filter(F.col("depth") > hi)
    out = []
    for depth in range(hi, lo, -1):
        key = F.substring("keys", (depth - lo - 1) * KEY + 1, KEY).alias("key")
        kids = front.select("*", key)
        here = rows.filter(F.col("depth") == depth).select("*", key)
        both = kids.withColumn("ends", F.lit(None).cast("string")).withColumn("_kid", F.lit(1)).unionByName(here.withColumn("_kid", F.lit(0)))
        merged = both.groupBy("key").agg(
            F.min("conv_id").alias("conv_id"),
            F.sum("n_convs").alias("n_convs"),
            F.sum("_kid").cast("long").alias("n_children"),
            F.greatest(F.sum(F.col("n_leaves") * F.col("_kid")), F.lit(1)).alias("n_leaves"),
            F.sum(F.col("saved_tokens") * F.col("_kid")).alias("_saved"),
            F.max("ends").alias("ends"),
            F.first("keys").alias("keys"),
            F.first("chars").alias("chars"),
        )
        own_saved = (F.col("n_convs") - 1) * F.element_at("chars", depth - lo)
        merged = merged.withColumn("depth", F.lit(depth).cast("long")).withColumn("saved_tokens", F.col("_saved") + own_saved)
        merged = cut_lineage(merged.select("key", *own, *path))
        # both sides come straight from tables, so a crowded parent is a skewed key that may be split
        parents = merged.select("key", F.col("conv_id").alias("parent_conv_id"))
        out.append(kids.join(parents, "key").select(*own[:2], "parent_conv_id", *own[2:]))
        front = merged.drop("key")
    top = front.select(*own[:2], F.lit(None).cast("long").alias("parent_conv_id"), *own[2:])
    return [*out, top]


def trie(turns: DataFrame, convs: DataFrame, group_turns: int = GROUP_TURNS) -> DataFrame:
    """Nodes of the trie over turns(conv_id, pos from 1, digest, chars) and convs(conv_id), see the module."""
    paths = cut_lineage(chained(turns))
    tails = paths.filter("last").groupBy("conv_id").agg(F.first("block").alias("block"), F.first("n").alias("n"), F.first(F.expr(f"substring(keys, -{KEY}, {KEY})")).alias("key"))
    deepest = tails.agg(F.max(F.struct("block", "n")).alias("m")).first().m
    bounds = block_bounds(1)
    while deepest is not None and len(bounds) <= deepest.block:
        bounds = block_bounds(bounds[-1][1] + 1)
    base = F.element_at(F.array(*[F.lit(lo).cast("long") for lo, _ in bounds]), F.col("block") + 1)
    ends = convs.join(tails, "conv_id", "left").select("conv_id", F.coalesce("key", F.lit(ROOT)).alias("key"), F.coalesce(base + F.col("n"), F.lit(0)).cast("long").alias("depth"))
    ends = cut_lineage(ended(ends))
    slim = ends.select(
        "conv_id", "depth", "n_convs", F.lit(0).cast("long").alias("n_children"), F.lit(0).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"), "ends"
    )
    finished: list[DataFrame] = []
    open_nodes = None
    for block in range(len(bounds) - 1, -1, -1):
        lo, hi = bounds[block]
        rows = slim.filter((F.col("depth") > lo) & (F.col("depth") <= hi))
        if open_nodes is not None:
            rows = rows.unionByName(open_nodes.drop("parent_conv_id"))
        rows = cut_lineage(rows.join(paths.filter(F.col("block") == block).select("conv_id", "top", "keys", "chars"), "conv_id"))
        crowded = rows.groupBy("top").agg(F.sum(F.size("chars")).alias("_turns")).filter(F.col("_turns") > group_turns).select("top")
        crowded = cut_lineage(crowded)
        if crowded.isEmpty():
            nodes = peel_in_tasks(rows, lo, hi)
        else:
            nodes = peel_in_tasks(rows.join(crowded, "top", "left_anti"), lo, hi)
            nodes = reduce(DataFrame.unionByName, peel_by_levels(rows.join(crowded, "top", "left_semi"), lo, hi), nodes)
        nodes = cut_lineage(nodes)
        finished.append(nodes.filter("parent_conv_id IS NOT NULL"))
        open_nodes = nodes.filter("parent_conv_id IS NULL")
        release(rows, crowded)
    shallow = slim.filter("depth = 0").withColumn("_kid", F.lit(0)).unionByName(open_nodes.drop("parent_conv_id").withColumn("_kid", F.lit(1)))
    root = shallow.groupBy().agg(
        F.min("conv_id").alias("conv_id"),
        F.lit(0).cast("long").alias("depth"),
        F.lit(None).cast("long").alias("parent_conv_id"),
        F.sum("n_convs").alias("n_convs"),
        F.sum("_kid").cast("long").alias("n_children"),
        F.greatest(F.sum("n_leaves"), F.lit(1)).cast("long").alias("n_leaves"),
        F.sum("saved_tokens").cast("long").alias("saved_tokens"),
        F.max(F.when(F.col("_kid") == 0, F.col("ends"))).alias("ends"),
    )
    root = cut_lineage(root.filter("conv_id IS NOT NULL"))
    top = root.select("conv_id").first()
    first_turns = open_nodes.withColumn("parent_conv_id", F.lit(top.conv_id if top else None).cast("long"))
    nodes = reduce(DataFrame.unionByName, [root, first_turns, *finished])
    return nodes.withColumn("ends_sha256", F.coalesce("ends", F.lit(EMPTY_HASH))).drop("ends")


def shared_head_trie(conversations: DataFrame, group_turns: int = GROUP_TURNS) -> DataFrame:
    """The trie of the conversations rebuilt by ``with_shared_heads``."""
    turns = cut_lineage(numbered_turns(conversations))
    rebuilt, convs = with_shared_heads(turns)
    return trie(rebuilt, convs, group_turns)


def conversation_trie(conversations: DataFrame, group_turns: int = GROUP_TURNS) -> DataFrame:
    """The trie of the conversations as they are."""
    turns = cut_lineage(numbered_turns(conversations))
    return trie(turns, turns.select("conv_id").distinct(), group_turns)
