"""Document fingerprints by a randomised edit embedding.

All texts share one random walk: at step t a text stands on a character c and emits it; a
shared random bit r(c, t) says whether it moves on to its next character. Equal stretches of
two texts walk in step, and after an edit the walks meet again, so edit distance becomes
Hamming distance between the emitted strings. The walk is computed by jumps: from step t a
character holds until the next t' with r(c, t') = 1, which a table gives at once.

A fingerprint samples the emitted string: of all steps walked, the ``SAMPLES`` with the least
shared priority, four random bits of the character at each, written as hex digits behind the
number of steps. Texts of different length share the sampled steps of their common part, so
fingerprints compare step by step; steps that only the longer text walks count as different.

``banded_copies`` finds near copies: bands of sampled bits are joined, and each member of a
band is verified against the band's smallest id.

Defined results: null is the empty text, whose fingerprint has no samples; equal texts have
equal fingerprints and likeness 1; an empty and a non-empty text have likeness 0; a single
document is its own next; rows that repeat an id are ordered by their text's hash; null ids
come last; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arborframe.lineage import cut_lineage

SAMPLES, PERIOD, CLASSES, SEED = 128, 4096, 256, 20240229
#: Characters walked together in one block, which bounds a task's memory (one longer text is a block).
BLOCK_CHARS = 4_000_000
STEP_DIGITS = 10


#: What a worker builds once: the tables and the sampler, the same in every process.
_kept: dict = {}


def tables() -> tuple[np.ndarray, np.ndarray]:
    """(jump, digit) by class * PERIOD + step % PERIOD: steps a character holds, and its four random bits."""
    if "tables" not in _kept:
        _kept["tables"] = _tables()
    return _kept["tables"]


def _tables() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    moves = rng.integers(0, 2, (CLASSES, PERIOD), dtype=np.uint8)
    moves[:, -1] = 1
    jump = np.ones((CLASSES, PERIOD), dtype=np.int32)
    for t in range(PERIOD - 2, -1, -1):
        jump[:, t] = np.where(moves[:, t] == 1, 1, jump[:, t + 1] + 1)
    return jump.ravel(), rng.integers(0, 16, (CLASSES, PERIOD), dtype=np.uint8).ravel()


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: pseudo random values of whole numbers."""
    x = x.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Sampler:
    """For any number of steps the sampled ones: those of least priority, in ascending order."""

    def __init__(self) -> None:
        self.upto, self.times, self.sets, self.current = 0, [0], [np.zeros(0, dtype=np.int64)], []

    def steps(self, total: int) -> np.ndarray:
        while self.upto < total:
            self._extend()
        return self.sets[bisect_right(self.times, total) - 1]

    def _extend(self) -> None:
        chunk = np.arange(self.upto, self.upto + (1 << 18))
        priority = mixed(chunk)
        bound = self.current[-1][0] if len(self.current) == SAMPLES else np.uint64(2**64 - 1)
        for at in np.flatnonzero(priority <= bound):
            if len(self.current) == SAMPLES and priority[at] > self.current[-1][0]:
                continue
            self.current = sorted([*self.current, (priority[at], int(chunk[at]))])[:SAMPLES]
            self.times.append(int(chunk[at]) + 1)
            self.sets.append(np.array(sorted(t for _, t in self.current), dtype=np.int64))
        self.upto += len(chunk)


def sampler() -> Sampler:
    if "sampler" not in _kept:
        _kept["sampler"] = Sampler()
    return _kept["sampler"]


def classes(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    return ((codes * np.uint32(2654435761)) >> np.uint32(24)).astype(np.uint8)


def _walk(flat: np.ndarray, offsets: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first step of every character, steps walked per text); texts in order of falling length."""
    jump, _ = tables()
    starts = np.zeros(len(flat), dtype=np.int32 if lengths.size and lengths[0] < 1 << 27 else np.int64)
    at = np.zeros(len(lengths), dtype=np.int64)
    active = len(lengths)
    for i in range(int(lengths[0]) if len(lengths) else 0):
        while lengths[active - 1] <= i:
            active -= 1
        here = offsets[:active] + i
        now = at[:active]
        starts[here] = now
        now += jump[flat[here].astype(np.int64) * PERIOD + (now & (PERIOD - 1))]
    return starts, at


def fingerprints(texts: list[str]) -> list[str]:
    """Fingerprints of whole texts; blocks of texts of like length walk together."""
    _, digit = tables()
    out = [""] * len(texts)
    order = sorted(range(len(texts)), key=lambda k: -len(texts[k]))
    at = 0
    while at < len(order):
        block, chars = [], 0
        while at < len(order) and (not block or chars + len(texts[order[at]]) <= BLOCK_CHARS):
            block.append(order[at])
            chars += len(texts[order[at]])
            at += 1
        lengths = np.array([len(texts[k]) for k in block], dtype=np.int64)
        offsets = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)
        flat = np.concatenate([classes(texts[k]) for k in block])
        starts, steps = _walk(flat, offsets, lengths)
        for k, low, n, total in zip(block, offsets, lengths, steps):
            chosen = sampler().steps(int(total))
            own = np.searchsorted(starts[low : low + n], chosen, side="right") - 1
            digits = digit[flat[low + own].astype(np.int64) * PERIOD + (chosen & (PERIOD - 1))] if n else np.zeros(0, np.uint8)
            out[k] = f"{int(total):0{STEP_DIGITS}x}" + "".join(map("0123456789abcdef".__getitem__, digits))
    return out


def likeness(a: str, b: str) -> float:
    """Estimated share of equal steps of two walks, from their fingerprints alone."""
    if a == b:
        return 1.0
    if int(a[:STEP_DIGITS], 16) > int(b[:STEP_DIGITS], 16):
        a, b = b, a
    few, many = int(a[:STEP_DIGITS], 16), int(b[:STEP_DIGITS], 16)
    short, long = sampler().steps(few), sampler().steps(many)
    both = int(np.searchsorted(long, few))
    if not both:
        return 0.0
    x = np.frombuffer(a[STEP_DIGITS:].encode(), dtype=np.uint8)[np.searchsorted(short, long[:both])]
    y = np.frombuffer(b[STEP_DIGITS:].encode(), dtype=np.uint8)[:both]
    share = float((x == y).sum()) / len(long)
    return max(0.0, (share - 1 / 16) / (1 - 1 / 16))  # four bits agree by chance once in sixteen


def edited(text: str, following: str) -> str:
    """The text with its last quarter replaced by as much of the following text's start."""
    quarter = len(text) // 4
    return text[: len(text) - quarter] + following[:quarter]


COLUMNS = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _finished(ids: list, texts: list[str], prints: list[str], following: list[str], following_prints: list[str]) -> list[tuple]:
    changed = [edited(t, f) for t, f in zip(texts, following)]
    changed_prints = fingerprints(changed)
    return [
        (i, len(t), hashlib.sha256(c.encode("utf-8", "surrogatepass")).hexdigest(), p, q, likeness(p, q), likeness(p, f))
        for i, t, c, p, q, f in zip(ids, texts, changed, prints, changed_prints, following_prints)
    ]


def with_next(docs: DataFrame) -> DataFrame:
    """COLUMNS per row of docs(doc_id, text), the next document being the next by ascending id.

    Documents are range-partitioned by id, so a task meets most next documents itself; only
    the last document of a partition waits for the first of the next one, in a small join.
    """
    names = [c.split(" ")[0] for c in COLUMNS.split(", ")]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    order = [F.col("doc_id").asc_nulls_last(), F.col("h").asc()]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")

    def stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part = TaskContext.get().partitionId()
        held: tuple | None = None  # (id, text, fingerprint) of the last document so far
        for batch in batches:
            for at in range(0, len(batch), 2000):
                piece = batch.iloc[at : at + 2000]
                ids = [None if pd.isna(i) else int(i) for i in piece["doc_id"]]
                texts = list(piece["text"])
                prints = fingerprints(texts)
                known = list(zip(ids, texts, prints))
                if held is None:
                    yield pd.DataFrame([("head", part, texts[0], None, *[None] * 2, prints[0], *[None] * 3)], columns=["kind", "part", "text", *names])
                line = ([held] if held else []) + known
                held = line[-1]
                done = _finished(*map(list, zip(*line[:-1])), [x[1] for x in line[1:]], [x[2] for x in line[1:]]) if len(line) > 1 else []
                if not done:
                    continue
                frame = pd.DataFrame(done, columns=names)
                frame.insert(0, "kind", "done")
                frame.insert(1, "part", part)
                frame.insert(2, "text", None)
                yield frame.astype({"doc_id": "Int64"})
        if held is not None:
            yield pd.DataFrame([("tail", part, held[1], held[0], *[None] * 2, held[2], *[None] * 3)], columns=["kind", "part", "text", *names])

    found = cut_lineage(rows.mapInPandas(stream, "kind string, part int, text string, " + COLUMNS))
    heads = found.filter("kind = 'head'").select("part", F.col("text").alias("next_text"), F.col("fingerprint").alias("next_print"))
    every = Window.orderBy("part")  # one number per partition
    after = heads.select("part").withColumn("next", F.coalesce(F.lead("part").over(every), F.min("part").over(Window.partitionBy()))).withColumnRenamed("part", "_part")
    tails = found.filter("kind = 'tail'").join(after, F.col("part") == F.col("_part")).drop("part", "_part").join(heads, F.col("next") == F.col("part"))

    def finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids = [None if pd.isna(i) else int(i) for i in batch["doc_id"]]
            done = _finished(ids, list(batch["text"]), list(batch["fingerprint"]), list(batch["next_text"]), list(batch["next_print"]))
            yield pd.DataFrame(done, columns=names).astype({"doc_id": "Int64"})

    last = tails.select("doc_id", "text", "fingerprint", "next_text", "next_print").mapInPandas(finish, COLUMNS)
    return found.filter("kind = 'done'").select(*names).unionByName(last)


def band_keys(fingerprint: str, bands: int, width: int) -> list[str]:
    """Per band: ``width`` of the sampled steps, chosen by least shared hash, with their digits."""
    steps = sampler().steps(int(fingerprint[:STEP_DIGITS], 16))
    if not len(steps):
        return ["empty"]
    out = []
    for band in range(bands):
        chosen = [int(np.argmin(mixed(steps * 64 + np.int64(band * width + s) * 1_000_003))) for s in range(width)]
        out.append(f"{band}:" + ",".join(f"{steps[c]}{fingerprint[STEP_DIGITS + c]}" for c in chosen))
    return out


def banded_copies(prints: DataFrame, least: float = 0.8, bands: int = 16, width: int = 4) -> DataFrame:
    """(doc_id, copy_of): the smallest id whose fingerprint shares a band and has likeness >= least.

    Every member of a band is compared with the band's smallest id only, so a band's work is
    linear in its size; prints(doc_id, fingerprint).
    """

    @F.udf("array<string>")
    def keys(fingerprint: str) -> list[str]:
        return band_keys(fingerprint, bands, width)

    rows = cut_lineage(prints.select("doc_id", "fingerprint", F.explode(keys("fingerprint")).alias("key")))
    first = rows.groupBy("key").agg(F.min("doc_id").alias("copy_of")).join(prints.select(F.col("doc_id").alias("copy_of"), F.col("fingerprint").alias("other")).distinct(), "copy_of")

    @F.pandas_udf("double")
    def alike(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([likeness(x, y) for x, y in zip(a, b)], dtype=float)

    pairs = rows.join(first, "key").filter(F.col("copy_of") < F.col("doc_id")).select("doc_id", "fingerprint", "copy_of", "other").distinct()
    return pairs.filter(alike("fingerprint", "other") >= least).groupBy("doc_id").agg(F.min("copy_of").alias("copy_of"))
