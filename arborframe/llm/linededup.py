"""Repeated and almost repeated lines over a corpus, found by a deletion-neighbourhood join.

A line is compared by its words (small letters, ASCII white space apart). Lines of at least
``min_words`` words with equal words repeat each other; lines of at least ``near_words``
words also when one word edit (insert, delete or replace) turns one into the other. A line
is dropped when an earlier line (by doc_id, then position) repeats it, and kept otherwise.

Two lines within one edit agree on all words but one when a word is deleted from one or
both: each line emits the hash of its words and of all its one-word deletions, equal
variants meet, and the word edit distance of the meeting lines is verified. Replacements
meet at the same deleted position, so a group's earliest line stands for all of it and no
pair list is made. Before that, lines that share neither their first nor their last half
with another line are left out: one edit leaves one half as it was.

Defined results: null text stays null, empty and blank texts and lines stay as they are, as
do lines under ``min_words``; the same line twice in one text keeps the first; rows that
repeat doc_id and text are one document and get the same result; a null doc_id counts as the
largest. The text of a document is its kept lines in order; other columns are untouched,
whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arborframe.lineage import cut_lineage, release
from arborframe.llm.names import own_columns, spare

MIN_WORDS, NEAR_WORDS = 4, 10
#: Largest table of ids that is broadcast; beyond it the same join is shuffled.
BROADCAST_ROWS = 1_000_000
#: Fixed values of the rolling hash over words.
MERSENNE, BASE = (1 << 61) - 1, 1_000_003 * 7919


def _ident() -> Column:
    return F.coalesce(F.col("doc_id").cast("decimal(19,0)"), F.lit(str(2**63)).cast("decimal(19,0)"))


def lines(docs: DataFrame, least: int = 1) -> DataFrame:
    """(id, text_hash, pos, ord, line, n) per line of at least ``least`` words; line: its
    words in small letters, one space apart; n: how many.

    Plain string functions and no word arrays, and each is written so that the planner
    evaluates it once per line: filters look at the raw line only.
    """
    raw, gap = F.col("raw"), r"[ \t\x0B\f\r]"
    word = r"[^ \t\x0B\f\r]"
    parts = docs.select(_ident().alias("id"), F.xxhash64("text").alias("text_hash"), F.posexplode(F.split("text", "\n")).alias("pos", "raw"))
    parts = parts.filter(raw.rlike(f"^{gap}*(?:{word}+{gap}+){{{least - 1}}}{word}"))
    low = F.lower(F.when(raw.rlike(r"  |[\t\x0B\f\r]"), F.regexp_replace(raw, gap + "+", " ")).otherwise(raw))
    n = F.octet_length("line") - F.octet_length(F.replace("line", F.lit(" "), F.lit(""))) + 1
    order = (F.col("id") * F.lit(2**31).cast("decimal(10,0)") + F.col("pos")).cast("decimal(38,0)")
    return parts.select("id", "text_hash", "pos", F.trim(low).alias("line")).withColumns({"n": n, "ord": order})


def _line_hash() -> list[Column]:
    return [F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), F.col("line")).alias("h2")]


def _halves() -> list[Column]:
    """Hashes of the first and last half, cut for the line's own length and for one word less."""
    keys = []
    for less in (0, 1):
        m = F.col("n") - less
        half = F.floor(m / 2).cast("int")
        for end, words in ((0, half), (1, half - m)):
            keys.append(F.xxhash64(F.lit(end), m, F.call_function("substring_index", F.col("line"), F.lit(" "), words.cast("int"))).alias(f"k{len(keys)}"))
    return keys


def deletion_variants(words: list[str], first: bool, last: bool) -> list[tuple[int, int, int]]:
    """(hash, length, deleted position) of the line itself (position -1) and of its one-word
    deletions; ``first``/``last`` say which half the edit may be in."""
    n = len(words)
    codes = [xxhash.xxh64_intdigest(w) % MERSENNE for w in words]
    prefix, power = [0], [1]
    for c in codes:
        prefix.append((prefix[-1] * BASE + c) % MERSENNE)
        power.append(power[-1] * BASE % MERSENNE)
    full, out = prefix[n], [(prefix[n], n, -1)]
    low, high = (0 if first else (n - 1) // 2), (n if last else (n + 1) // 2 + 1)
    for p in range(low, min(high, n)):
        tail = power[n - 1 - p]
        out.append(((prefix[p] * tail + full - prefix[p + 1] * tail) % MERSENNE, n - 1, p))
    return out


def within_one_edit(a: list[str], b: list[str]) -> bool:
    if abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    if len(a) == len(b):
        return a[i + 1 :] == b[i + 1 :]
    return a[i + 1 :] == b[i:] if len(a) > len(b) else a[i:] == b[i + 1 :]


def near_lines(docs: DataFrame, distinct: DataFrame, near_words: int) -> DataFrame:
    """(ord, near): the earliest other line within one edit of the line first seen at ord, if earlier.

    distinct(h1, ord, n, halves) holds every distinct line once.
    """
    halves = distinct.filter(F.col("n") >= near_words).select("ord", F.posexplode("halves").alias("kind", "key"))
    shared = halves.groupBy("key").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("key")
    # an edit behind an equal first half is in the last half, and the other way round
    open_lines = halves.join(shared, "key").groupBy("ord").agg(F.max(F.col("kind") % 2 == 1).alias("first"), F.max(F.col("kind") % 2 == 0).alias("last"))
    open_lines = cut_lineage(open_lines)
    wanted = cut_lineage(open_lines.select(F.floor(F.col("ord") / F.lit(2**31).cast("decimal(10,0)")).cast("decimal(19,0)").alias("id")).distinct())
    small = wanted.count() <= BROADCAST_ROWS
    some = docs.select("doc_id", "text", _ident().alias("id")).join(F.broadcast(wanted) if small else wanted, "id", "left_semi")
    texts = lines(some, near_words).select("ord", "line", *_line_hash())
    # ids may repeat with other texts: only the line the distinct table knows at that place counts
    known = distinct.select("ord", "h1", "h2").join(open_lines, "ord")
    texts = cut_lineage(texts.dropDuplicates(["ord", "h1", "h2"]).join(known, ["ord", "h1", "h2"]).select("ord", "line", "first", "last"))

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(o, *v) for o, line, first, last in zip(batch["ord"], batch["line"], batch["first"], batch["last"]) for v in deletion_variants(line.split(" "), first, last)]
            for at in range(0, len(rows), 100_000):
                yield pd.DataFrame(rows[at : at + 100_000], columns=["ord", "key", "length", "gone"])

    variants = cut_lineage(texts.mapInPandas(emit, "ord decimal(38,0), key long, length int, gone int"))
    by_place = variants.groupBy("key", "length", "gone").agg(F.min("ord").alias("m"), F.count(F.lit(1)).alias("c"))
    by_key = by_place.groupBy("key", "length").agg(
        F.min(F.when(F.col("gone") < 0, F.col("m"))).alias("whole"), F.min(F.when(F.col("gone") >= 0, F.col("m"))).alias("cut"), F.sum("c").alias("all")
    ).filter(F.col("all") > 1)
    meet = by_place.join(by_key, ["key", "length"]).select("key", "length", "gone", F.least("m", F.when(F.col("gone") < 0, F.col("cut")).otherwise(F.col("whole"))).alias("near"))
    pairs = variants.join(meet, ["key", "length", "gone"]).filter(F.col("near") < F.col("ord")).groupBy("ord").agg(F.min("near").alias("near"))
    both = pairs.join(texts.select("ord", "line"), "ord").join(texts.select(F.col("ord").alias("near"), F.col("line").alias("other")), "near")

    @F.pandas_udf("boolean")
    def verified(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([within_one_edit(x.split(" "), y.split(" ")) for x, y in zip(a, b)], dtype=bool)

    found = cut_lineage(both.filter(verified("line", "other")).select("ord", "near"))
    release(variants, texts, open_lines, wanted)
    return found


def repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS, near_words: int = NEAR_WORDS) -> DataFrame:
    """(id, text_hash, pos): the lines to drop."""
    spoken = lines(docs, min_words)
    first = spoken.select(*_line_hash(), "ord", "n", *_halves())
    distinct = first.groupBy("h1", "h2").agg(F.min("ord").alias("ord"), F.count(F.lit(1)).alias("c"), F.first("n").alias("n"), *[F.first(f"k{i}").alias(f"k{i}") for i in range(4)])
    distinct = cut_lineage(distinct.select("h1", "h2", "ord", "c", "n", F.array(*[f"k{i}" for i in range(4)]).alias("halves")))
    near = near_lines(docs, distinct, near_words)
    told = distinct.select("h1", "h2", "ord", "c").join(near, "ord", "left").filter((F.col("c") > 1) | F.col("near").isNotNull())
    told = cut_lineage(told.select("h1", "h2", F.least("ord", "near").alias("kept")))
    release(distinct)
    seen = spoken.select("id", "text_hash", "pos", "ord", *_line_hash())
    return seen.join(told, ["h1", "h2"]).filter(F.col("kept") < F.col("ord")).select("id", "text_hash", "pos")


def drop_repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS, near_words: int = NEAR_WORDS, counted: bool = False) -> DataFrame:
    """docs with the text reduced to its kept lines; ``counted`` adds n_lines and n_dropped."""
    ident, digest, places = spare(docs, "_id", "_hash", "_gone")
    gone = repeated_lines(docs, min_words, near_words).groupBy("id", "text_hash").agg(F.collect_set("pos").alias(places))
    gone = gone.select(F.col("id").alias(ident), F.col("text_hash").alias(digest), places)
    keyed = docs.withColumns({ident: _ident(), digest: F.xxhash64("text")})
    joined = keyed.join(gone, [ident, digest], "left")
    parts = F.split("text", "\n")
    kept = F.array_join(F.filter(parts, lambda x, i: ~F.array_contains(places, i)), "\n")
    text = F.when(F.col(places).isNull(), F.col("text")).otherwise(kept)
    out = dict(zip(docs.columns, own_columns(docs))) | {"text": text}
    if counted:
        out["n_lines"] = F.when(F.col("text").isNull(), F.lit(0)).otherwise(F.size(parts)).cast("long")
        out["n_dropped"] = F.when(F.col(places).isNull(), F.lit(0)).otherwise(F.size(places)).cast("long")
    return joined.select(*[c.alias(name) for name, c in out.items()])
