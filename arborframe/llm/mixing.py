"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Targets: source s gets min(level * weight_s, 2 * words_s) words, with one level for all
sources so that the targets sum to the asked share of all words. A target is met by whole
documents: full passes over the source, then a part of one more pass in hash order, whose
last document is the one that leaves the least gap.

Shards: the drawn documents of a source are laid out pass by pass in hash order and cut into
blocks of ``block_words`` words. Block counts per source are exact quotas. A binary tree over
the output shards splits them: a node hands its left half a multivariate-hypergeometric draw
from its remaining counts, so every shard receives an exact number of blocks per source and
all shards together use each block once. Every node draws from a generator seeded by its
range of shards, so a task computes the path to its own shard without the others. The blocks
of a source are permuted before they are dealt, and a shard is shuffled in itself.

Defined results: null, empty and blank texts have size 0 and are never drawn more than their
source is passed over in full; a source without words has target 0; null is a source of its
own, last in order; rows that repeat an id are drawn independently of each other only by
their text; equal hashes are ordered by id and size; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arborframe.lineage import cut_lineage
from arborframe.llm.names import own_columns, spare

#: Weights of the sources in order, repeating; words asked for; most repeats.
WEIGHTS, SHARE, REPEATS = (5, 2, 1), 1.5, 2
BLOCK_WORDS, SHARD_WORDS, SEED = 4096, 1_000_000, 42
#: Documents per bucket within a source: the unit in which running sums are computed.
BUCKET_ROWS = 2000


def size_of(text: Column) -> Column:
    """Number of words: runs of other signs than space, tab, line feed, vertical tab, form feed, return."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def hash_order(doc_id: Column, seed: int) -> Column:
    """Pseudo random place of a document in its source, 60 bits of an md5."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def source_targets(sizes: DataFrame) -> DataFrame:
    """(source, n, source_size, weight, target) per source of sizes(source, size).

    The sources are an aggregate, so their windows run over one small partition.
    """
    per = sizes.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("source_size"))
    every = Window.partitionBy()
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (rank % len(WEIGHTS) + 1).cast("int")).cast("double")
    per = per.withColumns({"weight": weight, "most": (F.col("source_size") * REPEATS).cast("double")})
    # sources fill up in the order of most / weight; the level that holds after k full sources
    # is (asked - their words) / (weights of the others); the first that does not fill the next
    # source stands, and later ones are lower
    ratio = F.col("most") / F.col("weight")
    before = Window.orderBy(ratio, F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumns({"asked": F.sum("source_size").over(every) * SHARE, "all_w": F.sum("weight").over(every)})
    per = per.withColumn("level", (F.col("asked") - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / (F.col("all_w") - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    per = per.withColumn("level", F.max(F.when(F.col("level") <= ratio, F.col("level"))).over(every))
    target = F.when(F.col("source_size") == 0, F.lit(0.0)).otherwise(F.least(F.col("most"), F.col("level") * F.col("weight")))
    return per.select("source", "n", "source_size", "weight", target.alias("target"))


def running_words(docs: DataFrame, per: DataFrame, seed: int) -> DataFrame:
    """docs with ``start``: words of the same source earlier in hash order.

    A source is cut into hash buckets of about BUCKET_ROWS documents; sums run inside buckets
    and over the list of buckets, so no task holds a source.
    """
    buckets = F.greatest(F.lit(1), F.ceil(F.col("n") / BUCKET_ROWS)).cast("long")
    width = F.ceil(F.lit(float(2**60)) / buckets).cast("long")
    h = hash_order(F.col("doc_id"), seed)
    rows = docs.withColumn("h", h).join(per, docs["source"].eqNullSafe(per["source"])).drop(per["source"])
    rows = cut_lineage(rows.withColumn("bucket", F.floor(F.col("h") / width).cast("long")))
    sums = rows.groupBy("source", "bucket").agg(F.sum("size").alias("w"))
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("source").alias("_s"), F.col("bucket").alias("_b"), F.coalesce(F.sum("w").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("source", "bucket").orderBy("h", "doc_id", "size", "row").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_in", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    found = rows.join(sums, rows["source"].eqNullSafe(sums["_s"]) & (rows["bucket"] == sums["_b"]))
    return found.withColumn("start", F.col("_before") + F.col("_in")).drop("_s", "_b", "_before", "_in")


def draw(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """How often the mix takes each row of docs(doc_id, text, source), as a written table:
    (row, doc_id, source, text_hash, size, source_size, target, start, times)."""
    columns = ["doc_id", "source", F.xxhash64("text", "source").alias("text_hash"), size_of(F.col("text")).alias("size")]
    sizes = cut_lineage(docs.select(F.monotonically_increasing_id().alias("row"), *columns))
    per = cut_lineage(source_targets(sizes))
    rows = cut_lineage(running_words(sizes, per, seed))
    full = F.floor(F.col("target") / F.greatest("source_size", F.lit(1))).cast("long")
    rows = rows.withColumns({"full": full, "part": F.col("target") - full * F.col("source_size")})
    whole = F.col("start") + F.col("size") <= F.col("part")
    # the one more document per source that leaves the smallest gap, if smaller than without it
    got = rows.groupBy("source").agg(F.first("part").alias("part"), F.coalesce(F.sum(F.when(whole, F.col("size"))), F.lit(0)).alias("got"))
    got = got.select(F.col("source").alias("_s"), (F.col("part") - F.col("got")).alias("gap"))
    off = F.abs(F.col("size") - F.col("gap"))
    rest = rows.filter(~whole).join(got, F.col("source").eqNullSafe(F.col("_s"))).filter((F.col("size") > 0) & (off < F.col("gap")))
    last = rest.groupBy("_s").agg(F.min(F.struct(off.alias("off"), "start", "row")).alias("pick")).select(F.col("pick.row").alias("row"), F.lit(1).alias("extra"))
    more = F.when(whole & (F.col("part") > 0), 1).otherwise(F.coalesce("extra", F.lit(0)))
    rows = rows.join(last, "row", "left").withColumn("times", (F.col("full") + more).cast("long"))
    return cut_lineage(rows.select("row", "doc_id", "source", "text_hash", "size", "source_size", "target", "start", "times"))


def shard_quotas(blocks: dict[int, int], shards: int, wanted: list[int], seed: int) -> list[tuple[int, int, int, int]]:
    """(shard, source number, first block, count) for the wanted shards, by the splitting tree.

    blocks: source number -> number of blocks. A node covers shards [low, high) and holds a
    count and a first block per source; its left half gets a share of the blocks in
    proportion to its shards, drawn without replacement.
    """
    keys = sorted(blocks)
    memo: dict[tuple[int, int], np.ndarray] = {}
    out = []
    for shard in wanted:
        low, high = 0, shards
        count, first = np.array([blocks[k] for k in keys], dtype=np.int64), np.zeros(len(keys), dtype=np.int64)
        while high - low > 1:
            mid = (low + high) // 2
            left = memo.get((low, high))
            if left is None:
                take = int(count.sum()) * (mid - low) // (high - low)
                rng = np.random.default_rng([seed, low, high])
                left = memo[low, high] = rng.multivariate_hypergeometric(count, take, method="marginals") if take else np.zeros_like(count)
            if shard < mid:
                high, count = mid, left
            else:
                low, count, first = mid, count - left, first + left
        out += [(shard, k, int(f), int(c)) for k, f, c in zip(keys, first, count) if c]
    return out


def mix(drawn: DataFrame, seed: int = SEED, block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS) -> DataFrame:
    """The mix: one row per document and time it is taken, (row, doc_id, source, size, pass,
    shard, position), its place in the shuffled output shards. drawn is the result of ``draw``."""
    passes = drawn.filter("times > 0").withColumn("pass", F.explode(F.sequence(F.lit(0), (F.col("times") - 1).cast("int"))))
    laid = passes.withColumn("block", F.floor((F.col("pass") * F.col("source_size") + F.col("start")) / block_words).cast("long"))
    per = laid.groupBy("source").agg((F.max("block") + 1).alias("blocks"), F.sum("size").alias("words"))
    per = cut_lineage(per.withColumn("number", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1))
    # what comes to the driver is one row per source, not per document
    known = {int(r["number"]): (int(r["blocks"]), int(r["words"])) for r in per.collect()}
    counts = {k: b for k, (b, _) in known.items()}
    shards = max(1, -(-sum(w for _, w in known.values()) // shard_words))

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # an affine step coprime to the number of blocks permutes the blocks of a source
        steps = {k: next(s for s in range(max(1, int(b * 0.618)), b + 2) if np.gcd(s, b) == 1) for k, b in counts.items()}
        for batch in batches:
            got = shard_quotas(counts, shards, batch["id"].tolist(), seed) if counts else []
            yield pd.DataFrame([(*q, steps[q[1]], counts[q[1]]) for q in got], columns=["shard", "number", "first", "count", "step", "blocks"])

    quotas = drawn.sparkSession.range(shards).mapInPandas(deal, "shard long, number int, first long, count long, step long, blocks long")
    places = quotas.withColumn("place", F.explode(F.sequence("first", F.col("first") + F.col("count") - 1)))
    wide = "decimal(19,0)"
    block = F.pmod(F.col("place").cast(wide) * F.col("step").cast(wide), F.col("blocks").cast("decimal(38,0)")).cast("long")
    dealt = places.select("shard", F.col("number").alias("_n"), block.alias("_block"))
    laid = laid.join(per.select(F.col("source").alias("_s"), "number"), F.col("source").eqNullSafe(F.col("_s")))
    mixed = laid.join(dealt, (F.col("number") == F.col("_n")) & (F.col("block") == F.col("_block")))
    local = Window.partitionBy("shard").orderBy(F.xxhash64(F.lit(seed), "doc_id", "pass"), "doc_id", "pass", "row")
    return mixed.withColumn("position", F.row_number().over(local) - 1).select("row", "doc_id", "source", "size", "pass", "shard", "position")


def taken_words(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """(doc_id, size, source_size, target, taken) per row of docs; taken is summed from the mix."""
    drawn = draw(docs, seed)
    taken = mix(drawn, seed).groupBy("row").agg(F.sum("size").alias("taken"))
    return drawn.join(taken, "row", "left").select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """The mix as documents: every row of docs as often as it is taken, columns as they were."""
    drawn = draw(docs, seed)
    got = mix(drawn, seed).groupBy("row").agg(F.count(F.lit(1)).alias("times"))
    none, ident, digest, times, of, place, turn = spare(docs, "_none", "_id", "_hash", "_times", "_of", "_k", "_pass")
    key = {none: F.col("doc_id").isNull(), ident: F.coalesce(F.col("doc_id"), F.lit(0)).cast("long")}
    # rows that repeat id, text and source share their draws evenly
    shared = drawn.drop("times").join(got, "row").withColumns(key).groupBy(none, ident, F.col("text_hash").alias(digest)).agg(F.sum("times").alias(times))
    keyed = docs.withColumns(key | {digest: F.xxhash64("text", "source")}).join(shared, [none, ident, digest])
    same = Window.partitionBy(none, ident, digest)
    keyed = keyed.withColumns({of: F.count(F.lit(1)).over(same), place: F.row_number().over(same.orderBy(F.lit(0)))})
    own = F.floor(F.col(times) / F.col(of)) + F.when(F.col(place) <= F.col(times) % F.col(of), 1).otherwise(0)
    return keyed.withColumn(turn, F.explode(F.sequence(F.lit(0), own.cast("int")))).filter(F.col(turn) > 0).select(*own_columns(docs))
