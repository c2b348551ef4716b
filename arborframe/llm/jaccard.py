"""Near-duplicate documents by the Jaccard similarity of their word shingles, without misses.

Documents whose sets of five-word shingles have a similarity of at least 4/5 are linked.
All such pairs are found: with the shingles of every set in one order, two sets that
similar share one of their first n - ceil(4n/5) + 1 (a similarity of 4/5 needs at least
4n/5 common shingles of either set). The order is by how often a shingle occurs in all
documents, then by hash; shingles share counters, so a rare one may count as a more common one. The order
decides the cost, never the result. A pair that meets at its
first common shingle has a bound on its overlap by the positions there and goes on only
when that suffices. Candidates then meet by parity sketches: bit i of a sketch says whether an odd
number of shingles fall on i, so two sketches differ in at most as many bits as the sets differ
in shingles, and no similar pair is lost. A sketch has about a bit per shingle, a sixty-fourth of
the set. What is left is verified on the whole sets.

Equal sets are one class first. Classes are then linked by SimHash, as in ``simhash``: the fingerprints
of all texts within 4 bits are found by the general pigeonhole, each fingerprint goes on with the least of its links, and
these pairs are verified on the whole sets as well, since texts within 4 bits can be less similar. That finds the
near copies; the prefixes find the similar pairs that SimHash misses. Each class is linked for that linked with the least class of its
shingles; in the second round only classes of unlike components are paired, so a group of
m copies makes few of its m * m pairs while every pair that could join two groups is tried.

Defined results: words and small letters as in ``simhash``; all words are one shingle when
there are fewer than five; texts without words have equal, empty sets; a set is known by its
64-bit hash, a shingle as well.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arborframe.lineage import cut_lineage, release
from arborframe.llm.simhash import fingerprint, fingerprint_links, first_rows, shingles
from arborframe.operators.graph import connected_components

SIZE = 5
#: The least similarity as a fraction.
OVER, UNDER = 4, 5
#: Counters of the shingles of all documents, and counters written as one row. Shingles of a counter share its count.
COUNTERS, BLOCK = 1 << 22, 1 << 12
#: Largest table of hashes that is broadcast; beyond it the same join is shuffled.
BROADCAST_ROWS = 1_000_000
#: Texts made into sets at once, which bounds a task's memory.
HELD = 500


def shingle_set(text: str | None, size: int = SIZE) -> np.ndarray:
    """Ascending hashes of the different shingles."""
    digest = xxhash.xxh64_intdigest
    runs = set(shingles(text, size))
    return np.sort(np.fromiter((digest(r, 42) for r in runs), dtype=np.uint64, count=len(runs)).view(np.int64))


def set_hash(shingled: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh64_intdigest(shingled.astype("<i8").tobytes(), 7)).view(np.int64))


def sketch(shingled: np.ndarray) -> bytes:
    """Parity of the number of shingles per bit; the bits are a power of two, at least the set's size and 64."""
    bits = 64
    while bits < len(shingled):
        bits *= 2
    on = np.bincount((shingled & (bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(on.astype(np.uint8), bitorder="little").tobytes()


def may_be_similar(a: bytes, b: bytes, size_a: int, size_b: int) -> bool:
    """Whether the sketches leave room for a similar pair; the longer one is folded to the other's length."""
    one, two = np.frombuffer(a, "<u8"), np.frombuffer(b, "<u8")
    while len(one) > len(two):
        one = one[: len(one) // 2] ^ one[len(one) // 2 :]
    while len(two) > len(one):
        two = two[: len(two) // 2] ^ two[len(two) // 2 :]
    differ = int(np.bitwise_count(one ^ two).sum())
    return differ * (OVER + UNDER) <= (size_a + size_b) * (UNDER - OVER)


def prefix(shingled: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The first shingles of a set, rare ones first, of which any similar set has one."""
    n = len(shingled)
    return shingled[np.lexsort((shingled, weights[shingled & (len(weights) - 1)]))][: n - -(-OVER * n // UNDER) + 1] if n else shingled


def shingle_weights(docs: DataFrame, size: int) -> np.ndarray:
    """How many documents have a shingle of each counter, over all documents, as ascending 16-bit weights (1024 times the binary logarithm)."""

    def blocks(counts: dict[int, np.ndarray], packed: Callable) -> Iterator[pd.DataFrame]:
        rows = [(b, packed(c)) for b, c in counts.items() if c.any()]
        for at in range(0, len(rows), 64):
            yield pd.DataFrame(rows[at : at + 64], columns=["block", "counts"])

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros(COUNTERS, dtype=np.uint32)
        for batch in batches:
            for t in batch["text"]:
                np.add.at(counts, shingle_set(t, size) & (COUNTERS - 1), 1)
        yield from blocks(dict(enumerate(counts.reshape(-1, BLOCK))), lambda c: zlib.compress(c.tobytes(), 1))

    def added(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: dict[int, np.ndarray] = {}
        for batch in batches:
            for b, part in zip(batch["block"], batch["counts"], strict=True):
                counts[b] = counts.get(b, 0) + np.frombuffer(zlib.decompress(part), np.uint32).astype(np.uint64)
        yield from blocks(counts, lambda c: np.round(np.log2(c + 1.0) * 1024).astype(np.uint16).tobytes())

    schema = "block int, counts binary"
    rows = docs.select("text").mapInPandas(counted, schema).repartition("block").mapInPandas(added, schema).toPandas()
    weights = np.zeros((COUNTERS // BLOCK, BLOCK), dtype=np.uint16)
    for b, part in zip(rows["block"], rows["counts"], strict=True):
        weights[b] = np.frombuffer(part, np.uint16)
    return weights.reshape(-1)


def with_prefix(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """(doc_id, text_hash, fp, n, prefix, sketch, print) per row: hash and size of the shingle set, its first shingles, its sketch; the text's SimHash."""
    weights = shingle_weights(docs, size)

    @F.pandas_udf("fp long, n int, prefix array<long>, sketch binary, print long")
    def described(texts: pd.Series) -> pd.DataFrame:
        out = []
        for t in texts:
            own = shingle_set(t, size)
            out.append((set_hash(own), len(own), prefix(own, weights), sketch(own), int(np.uint64(fingerprint(t)).view(np.int64))))
        return pd.DataFrame(out, columns=["fp", "n", "prefix", "sketch", "print"])

    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), described("text").alias("d"))
    return rows.select("doc_id", "text_hash", "d.fp", "d.n", "d.prefix", "d.sketch", "d.print")


def plausible(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Those of pairs(u, v) whose sketches leave room for similarity."""

    @F.pandas_udf("boolean")
    def room(a: pd.Series, b: pd.Series, size_a: pd.Series, size_b: pd.Series) -> pd.Series:
        return pd.Series([may_be_similar(*row) for row in zip(a, b, size_a, size_b, strict=True)], dtype=bool)

    one = classes.select(F.col("fp").alias("u"), F.col("sketch").alias("a"), F.col("n").alias("size_a"))
    two = classes.select(F.col("fp").alias("v"), F.col("sketch").alias("b"), F.col("n").alias("size_b"))
    return pairs.join(one, "u").join(two, "v").filter(room("a", "b", "size_a", "size_b")).select("u", "v")


def verified(docs: DataFrame, rows: DataFrame, classes: DataFrame, pairs: DataFrame, size: int) -> DataFrame:
    """Those of pairs(u, v) whose whole sets are similar."""
    pairs = cut_lineage(plausible(pairs, classes))
    wanted = pairs.select(F.explode(F.array("u", "v")).alias("fp")).distinct()
    # one document a set; a row that repeats id and text gives its set again, and the pair with it
    texts = rows.join(wanted, "fp", "left_semi").groupBy("fp").agg(F.min(F.struct("text_hash", "doc_id")).alias("d"))
    texts = cut_lineage(texts.select("fp", F.col("d.text_hash").alias("_hash"), F.col("d.doc_id").alias("_id")))
    here = (F.xxhash64("text") == F.col("_hash")) & F.col("doc_id").eqNullSafe(F.col("_id"))
    some = docs.select("doc_id", "text").join(F.broadcast(texts) if texts.count() <= BROADCAST_ROWS else texts, here)

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), HELD):
                part = batch.iloc[at : at + HELD]
                yield pd.DataFrame({"fp": part["fp"], "own": [shingle_set(t, size) for t in part["text"]]})

    known = cut_lineage(some.select("fp", "text").mapInPandas(sets, "fp long, own array<long>"))
    both = pairs.join(known.select(F.col("fp").alias("u"), F.col("own").alias("a")), "u").join(known.select(F.col("fp").alias("v"), F.col("own").alias("b")), "v")
    shared = F.size(F.array_intersect("a", "b"))
    similar = shared * (OVER + UNDER) >= (F.size("a") + F.size("b")) * OVER
    found = cut_lineage(both.filter(similar).select("u", "v").distinct())
    release(pairs, texts, known)
    return found


def fingerprint_pairs(prints: DataFrame, max_bits: int = 4) -> DataFrame:
    """(u, v), u < v: pairs of set hashes whose texts' SimHash fingerprints differ in at most ``max_bits`` bits, from prints(fp, print).

    A set is paired with the least set of its fingerprint, that one with the least set of the least fingerprint linked: as many
    pairs as sets and fingerprints, whatever the size of a group of near copies.
    """
    least = cut_lineage(prints.groupBy("print").agg(F.min("fp").alias("least")))
    links = cut_lineage(fingerprint_links(least.select(F.col("print").alias("fp")), max_bits).distinct())
    lowest = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v"))).groupBy("u").agg(F.min("v").alias("v"))
    one, two = least.select(F.col("print").alias("u"), F.col("least").alias("a")), least.select(F.col("print").alias("v"), F.col("least").alias("b"))
    pairs = prints.join(least, "print").select(F.col("fp").alias("a"), F.col("least").alias("b")).unionByName(lowest.join(one, "u").join(two, "v").select("a", "b"))
    pairs = cut_lineage(pairs.filter("a <> b").select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct())
    release(links, least)
    return pairs


def similar_links(docs: DataFrame, rows: DataFrame, classes: DataFrame, near: DataFrame, size: int = SIZE) -> DataFrame:
    """(u, v), u < v: links of set hashes that have the components of all similar pairs of classes(fp, n, prefix, sketch).

    ``near`` are pairs that are similar; what they group is not tried again.
    """
    keys = classes.select("fp", "n", F.posexplode("prefix").alias("i", "key"))
    # only the keys are shuffled to be counted; most occur once and go no further
    shared = cut_lineage(classes.select(F.explode("prefix").alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("key"))
    met = cut_lineage(keys.join(F.broadcast(shared) if shared.count() <= BROADCAST_ROWS else shared, "key"))
    least = cut_lineage(met.groupBy("key").agg(F.min(F.struct("fp", "n")).alias("least")))
    held, met = met, cut_lineage(met.join(least, "key"))
    release(shared, held, least)
    sized = lambda a, b: (a * OVER <= b * UNDER) & (b * OVER <= a * UNDER)
    star = met.filter((F.col("fp") != F.col("least.fp")) & sized(F.col("n"), F.col("least.n")))
    star = star.select(F.least("fp", "least.fp").alias("u"), F.greatest("fp", "least.fp").alias("v")).distinct()
    known = connected_components(near, by=())
    of = lambda side: known.select(F.col("node").alias(side), F.col("component").alias(f"_{side}"))
    star = star.join(of("u"), "u", "left").join(of("v"), "v", "left").filter(F.coalesce("_u", "u") != F.coalesce("_v", "v")).select("u", "v")
    found = verified(docs, rows, classes, star, size)
    first = cut_lineage(near.unionByName(found))
    release(found)
    groups = connected_components(first, by=()).select(F.col("node").alias("fp"), "component")
    grouped = met.join(groups, "fp", "left").select("key", "fp", "n", "i", F.coalesce("component", "fp").alias("group"))
    grouped = cut_lineage(grouped)
    mixed = cut_lineage(grouped.groupBy("key").agg(F.min("group").alias("low"), F.max("group").alias("high")).filter("low < high").select("key"))
    # a key's members are paired only where it joins several groups
    left = cut_lineage(grouped.join(mixed, "key", "left_semi"))
    a, b = left.select("key", *[F.col(c).alias(f"{c}_a") for c in ("fp", "n", "i", "group")]), left.select("key", *[F.col(c).alias(f"{c}_b") for c in ("fp", "n", "i", "group")])
    bound = (F.least(F.col("n_a") - F.col("i_a"), F.col("n_b") - F.col("i_b"))) * (OVER + UNDER) >= (F.col("n_a") + F.col("n_b")) * OVER
    pairs = a.join(b, "key").filter((F.col("fp_a") < F.col("fp_b")) & (F.col("group_a") != F.col("group_b")) & sized(F.col("n_a"), F.col("n_b")) & bound)
    second = verified(docs, rows, classes, pairs.select(F.col("fp_a").alias("u"), F.col("fp_b").alias("v")).distinct().join(first, ["u", "v"], "left_anti"), size)
    links = cut_lineage(first.unionByName(second))
    release(met, grouped, mixed, left, first, second)
    return links


def keep_first(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """One row of docs per group of similar documents, chosen as in ``simhash.keep_first``."""
    described = cut_lineage(with_prefix(docs, size))
    rows = cut_lineage(described.select("doc_id", "text_hash", "fp"))
    sets = cut_lineage(described.select("fp", "n", "prefix", "sketch").dropDuplicates(["fp"]))
    prints = cut_lineage(described.select("fp", "print").distinct())
    release(described)
    close = fingerprint_pairs(prints)
    near = verified(docs, rows, sets, close, size)
    links = similar_links(docs, rows, sets, near, size)
    linked = connected_components(links, by=()).withColumnRenamed("node", "fp")
    release(sets, prints, close, near, links)
    classes = rows.select("fp").distinct().join(linked, "fp", "left").select("fp", F.coalesce("component", "fp").alias("component"))
    return first_rows(docs, rows, cut_lineage(classes))
