"""Near-duplicate documents by SimHash, linked with the general pigeonhole principle.

Fingerprints that differ in at most ``max_bits`` bits are linked. The bits are grouped
into partitions of correlated bits, and partition i gets a threshold T_i >= -1 with
sum(T_i + 1) = max_bits + 1: two fingerprints within max_bits then differ in at most T_i
bits on some partition (otherwise they would differ in sum(T_i + 1) > max_bits bits).
Each fingerprint is stored under its value of every partition and probes all values
within T_i of its own. Grouping and thresholds come from bit counts and value counts over
all fingerprints; they decide the cost, never the result.

Defined results: a null or blank text has no shingles and the fingerprint zero, which is
linked like any other; copies share a fingerprint; rows that repeat a doc_id stay rows; a
null doc_id is kept and never chosen as component id while another id is there. Columns
beside ``doc_id`` and ``text`` are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arborframe.lineage import cut_lineage, release
from arborframe.llm.names import own_columns, spare
from arborframe.operators.graph import connected_components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER_ASCII = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
BITS = 64
#: Relative cost of one probe row (it is shuffled) to one candidate pair (it is compared in place).
PROBE_COST = 8.0


def shingles(text: str | None, size: int) -> list[str]:
    """Runs of ``size`` words with repeats; all words as one run when there are fewer."""
    words = WORD.findall((text or "").translate(LOWER_ASCII) if not (text or "").isascii() else (text or "").lower())
    if not words:
        return []
    if len(words) < size:
        return [" ".join(words)]
    return list(map(" ".join, zip(*(words[i:] for i in range(size)))))


def fingerprint(text: str | None, size: int = 4) -> int:
    """Bit b is one when it is set in more than half of the shingle hashes."""
    runs = shingles(text, size)
    if not runs:
        return 0
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(r, 42) for r in runs), dtype="<u8", count=len(runs))
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), 65536):
        part = hashes[at : at + 65536].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits((2 * ones > len(runs)).astype(np.uint8), bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, size: int = 4) -> DataFrame:
    """(doc_id, text_hash, fp) per input row; fp is the fingerprint as a signed 64-bit number."""

    @F.pandas_udf("long")
    def prints(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, size) for t in texts], dtype=np.uint64).view(np.int64))

    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), prints(F.col("text")).alias("fp"))


def bit_statistics(fps: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints and how often each two bits are set together, over all rows."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        both, n = np.zeros((BITS, BITS)), 0
        for batch in batches:
            bits = np.unpackbits(batch["fp"].to_numpy().astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
            both += (bits.T @ bits).astype(np.float64)
            n += len(bits)
        if n:
            i, j = np.divmod(np.arange(BITS * BITS), BITS)
            yield pd.DataFrame({"i": np.r_[i, -1], "j": np.r_[j, -1], "n": np.r_[both.ravel(), n]})

    sums = fps.select("fp").mapInPandas(count, "i long, j long, n double").groupBy("i", "j").agg(F.sum("n").alias("n")).toPandas()
    together = np.zeros((BITS, BITS))
    cells = sums[sums["i"] >= 0]
    together[cells["i"].to_numpy(int), cells["j"].to_numpy(int)] = cells["n"]
    total = sums.loc[sums["i"] < 0, "n"]
    return int(total.iloc[0]) if len(total) else 0, together


def correlated_groups(n: int, together: np.ndarray, parts: int) -> list[list[int]]:
    """Split the bits into ``parts`` groups of near-equal width, each grown from its most
    balanced free bit by the bits most correlated with the group."""
    p = np.diag(together) / max(n, 1)
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs((together / max(n, 1) - np.outer(p, p)) / np.outer(sd, sd))
    free, groups = set(range(BITS)), []
    for k in range(parts):
        width = len(free) // (parts - k)
        group = [max(sorted(free), key=lambda b: sd[b])]
        free.discard(group[0])
        while len(group) < width:
            nxt = max(sorted(free), key=lambda b: corr[b, group].sum())
            group.append(nxt)
            free.discard(nxt)
        groups.append(sorted(group))
    return groups


def ball_size(width: int, radius: int) -> int:
    return sum(_choose(width, r) for r in range(radius + 1))


def _choose(n: int, k: int) -> int:
    out = 1
    for i in range(k):
        out = out * (n - i) // (i + 1)
    return out


def allocate(costs: list[list[float]], total: int) -> tuple[float, list[int]]:
    """Thresholds T_i >= -1 with sum(T_i + 1) = total at the least summed cost;
    costs[i][t] is the cost of T_i = t - 1. Dynamic programme over partitions."""
    best: list[tuple[float, list[int]]] = [(0.0, [])] + [(float("inf"), [])] * total
    for row in costs:
        best = [
            min(((best[used - t][0] + row[t], [*best[used - t][1], t - 1]) for t in range(min(used, len(row) - 1) + 1)), key=lambda c: c[0])
            for used in range(total + 1)
        ]
    return best[total]


def _part(fp, bits: list[int]):
    """The bits of one partition, moved together to the low end."""
    out = F.lit(0).cast("long")
    for to, b in enumerate(bits):
        out = out.bitwiseOR(F.shiftleft(F.shiftrightunsigned(fp, b).bitwiseAND(F.lit(1).cast("long")), to))
    return out


def _masks(width: int, radius: int) -> list[int]:
    masks, last = [0], [(0, -1)]
    for _ in range(radius):
        last = [(m | 1 << b, b) for m, top in last for b in range(top + 1, width)]
        masks += [m for m, _ in last]
    return masks


def _ball(part: int, bits: list[int], radius: int):
    """Keys of all values within ``radius`` bits of a fingerprint's value of one partition."""
    masks = F.array(*[F.lit(m).cast("long") for m in _masks(len(bits), radius)])
    return F.transform(masks, lambda m: F.struct(F.lit(part).alias("part"), _part(F.col("fp"), bits).bitwiseXOR(m).alias("value")))


def plan_partitions(fps: DataFrame, max_bits: int, max_radius: int = 2) -> list[tuple[list[int], int]]:
    """[(bits, threshold)] of the cheapest grouping into 2 to max_bits + 1 partitions.

    Candidate pairs at threshold 0 are counted from the values of all fingerprints; wider
    thresholds scale that count by the odds that single bits differ.
    """
    n, together = bit_statistics(fps)
    p = np.diag(together) / max(n, 1)
    odds = 2 * p * (1 - p) / np.maximum(1 - 2 * p * (1 - p), 1e-9)
    options = {m: correlated_groups(n, together, m) for m in range(2, max_bits + 2)}
    values = F.array(*[F.struct(F.lit(m).alias("m"), F.lit(i).alias("i"), _part(F.col("fp"), bits).alias("v")) for m, groups in options.items() for i, bits in enumerate(groups)])
    counts = fps.select(F.explode(values).alias("g")).groupBy("g.m", "g.i", "g.v").agg(F.count(F.lit(1)).cast("double").alias("c"))
    same = {(r["m"], r["i"]): r["pairs"] for r in counts.groupBy("m", "i").agg(F.sum(F.col("c") * F.col("c")).alias("pairs")).collect()}
    plans = []
    for m, groups in options.items():
        costs = []
        for i, bits in enumerate(groups):
            e = [1.0] + [0.0] * max_radius  # elementary symmetric sums of the odds
            for o in odds[bits]:
                for k in range(max_radius, 0, -1):
                    e[k] += e[k - 1] * o
            costs.append([0.0] + [same.get((m, i), 0.0) * sum(e[: r + 1]) + PROBE_COST * n * (ball_size(len(bits), r) + 1) for r in range(max_radius + 1)])
        cost, thresholds = allocate(costs, max_bits + 1)
        plans.append((cost, [(bits, t) for bits, t in zip(groups, thresholds) if t >= 0]))
    return min(plans, key=lambda c: c[0])[1]


def fingerprint_links(fps: DataFrame, max_bits: int = 4) -> DataFrame:
    """(u, v), u < v: pairs of distinct fingerprints that differ in 1 to ``max_bits`` bits.

    fps(fp) holds each fingerprint once. A pair may be found through several partitions;
    it is kept for each, callers that need it once apply distinct().
    """
    plan = plan_partitions(fps, max_bits)
    stored = F.array(*[F.struct(F.lit(i).alias("part"), _part(F.col("fp"), bits).alias("value")) for i, (bits, _) in enumerate(plan)])
    probes = F.concat(*[_ball(i, bits, t) for i, (bits, t) in enumerate(plan)])
    left = fps.select(F.col("fp").alias("u"), F.explode(stored).alias("k")).select("u", "k.part", "k.value")
    right = fps.select(F.col("fp").alias("v"), F.explode(probes).alias("k")).select("v", "k.part", "k.value")
    close = F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= max_bits
    found = left.join(right, (left["part"] == right["part"]) & (left["value"] == right["value"]) & (F.col("u") != F.col("v")) & close)
    return found.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))


def _grouped(docs: DataFrame, size: int, max_bits: int) -> tuple[DataFrame, DataFrame]:
    """(rows, classes): rows(doc_id, text_hash, fp) of all documents and classes(fp, component)."""
    rows = cut_lineage(with_fingerprint(docs, size))
    fps = cut_lineage(rows.select("fp").distinct())
    linked = connected_components(fingerprint_links(fps, max_bits).distinct(), by=()).withColumnRenamed("node", "fp")
    classes = cut_lineage(fps.join(linked, "fp", "left").select("fp", F.coalesce("component", "fp").alias("component")))
    release(fps)
    return rows, classes


def near_duplicates(docs: DataFrame, size: int = 4, max_bits: int = 4) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of docs(doc_id, text).

    Texts are read once and never shuffled; the rest works on (doc_id, fingerprint).
    """
    rows, classes = _grouped(docs, size, max_bits)
    least = rows.groupBy("fp").agg(F.min("doc_id").alias("_id")).join(classes, "fp").groupBy("component").agg(F.min("_id").alias("component_id"))
    ids = cut_lineage(classes.join(least, "component").select("fp", "component_id"))
    return rows.join(ids, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, size: int = 4, max_bits: int = 4) -> DataFrame:
    """One row of docs per group: that with the smallest doc_id, then the smallest text hash.
    All columns are kept; among rows that repeat id and text one is kept."""
    return first_rows(docs, *_grouped(docs, size, max_bits))


def first_rows(docs: DataFrame, rows: DataFrame, classes: DataFrame) -> DataFrame:
    """The rows of docs that ``keep_first`` keeps, from rows(doc_id, text_hash, fp) and classes(fp, component)."""
    ident = F.struct(F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).cast("long").alias("id"), F.col("text_hash").alias("hash"))
    first = rows.groupBy("fp").agg(F.min(ident).alias("first")).join(classes, "fp").groupBy("component").agg(F.min("first").alias("first"))
    keys = spare(docs, "_none", "_id", "_hash")
    chosen = first.select(*[F.col(f"first.{field}").alias(key) for field, key in zip(("none", "id", "hash"), keys)]).distinct()
    keyed = docs.withColumns(dict(zip(keys, (F.col("doc_id").isNull(), F.coalesce("doc_id", F.lit(0)).cast("long"), F.xxhash64("text")))))
    kept = keyed.join(chosen, keys, "left_semi")
    (place,) = spare(keyed, "_row")
    order = Window.partitionBy(*keys).orderBy(F.lit(0))
    return kept.withColumn(place, F.row_number().over(order)).filter(F.col(place) == 1).select(*own_columns(docs))
