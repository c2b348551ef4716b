"""Packing token sequences with Martello-Toth dominance reduction and best fit.

Every document becomes its token ids and an end id. Longer documents are cut into pieces of
``capacity`` tokens, of which the first may be shorter. Pieces are then put into as few
sequences of ``capacity`` tokens as possible. Only the lengths matter for that, so the
packing is solved on the counts per length: at most ``capacity`` numbers, whatever the
number of documents.

1. Reduction: for the longest open length j, a small set that dominates every other way to
   fill j's sequence is fixed for good: j alone when nothing fits, j with the longest fitting
   partner when at most one more fits or the fit is exact, and the same or j with the best
   pair under the Martello-Toth conditions when at most two more fit.
2. Best fit, longest first, for the lengths that no rule settles.

The solution is a list of runs: "the next n pieces of length w go to sequences s, s + 1, ...,
k in each, from offset o". Pieces are numbered within their length by hash buckets, so a
common length is counted in many tasks, and each piece looks up its run.

Defined results: a null, empty or blank text has its own ids (none for null and empty) and
the end id; special-token strings in a text are encoded as the tokenizer does; rows that
repeat an id are packed like other rows, in an order set by id and content; pieces of equal
length are interchangeable; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arborframe.lineage import cut_lineage

CAPACITY, END_ID = 1024, 2
#: Pieces per bucket when pieces are numbered within their length.
BUCKET_ROWS = 4000

Run = tuple[int, int, int, int, int, int]  # length, first number, how many, first sequence, pieces per sequence, offset


def tested(text: str) -> bool:
    """Only signs for which both encoders were compared: U+0000 to U+00FF."""
    if text.isascii():
        return True
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class Ids:
    """Token ids of a text by a byte-level BPE vocabulary.

    The same merges are read from the rank file by a faster encoder; texts that hold a
    special token or signs beyond the tested ranges go to the tokenizer file itself.
    """

    def __init__(self, tokenizer: str, ranks: str | None = None, pattern: str | None = None) -> None:
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(tokenizer)
        self.special = [t.content for t in self.slow.get_added_tokens_decoder().values()]
        self.fast = None
        if ranks is not None:
            import tiktoken

            with open(ranks, "rb") as lines:
                merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=merges, special_tokens={})

    def __call__(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, dtype="<u4")
        if self.fast is None or any(s in text for s in self.special) or not tested(text):
            return np.asarray(self.slow.encode(text, add_special_tokens=False).ids, dtype="<u4")
        return self.fast.encode_to_numpy(text, disallowed_special=()).astype("<u4")


def default_vocabulary() -> dict[str, str]:
    import public_tokenizers

    return {"tokenizer": public_tokenizers.path("byte_bpe_50k.json"), "ranks": public_tokenizers.path("byte_bpe_50k.tiktoken"), "pattern": public_tokenizers.PATTERN}


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of n tokens."""
    head = n % capacity if n > capacity else n
    out = [(0, head)] if head else []
    return out + [(s, capacity) for s in range(head, n, capacity)]


def pieces(docs: DataFrame, vocabulary: dict[str, str], capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every document; ids stay in the task."""

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = Ids(**vocabulary)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                ids = np.append(encode(text if isinstance(text, str) else ""), np.uint32(end_id)).astype("<u4")
                raw = memoryview(ids.tobytes())
                rows += [(doc_id, k, s, n, zlib.crc32(raw[4 * s : 4 * (s + n)])) for k, (s, n) in enumerate(cut(len(ids), capacity))]
            frame = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
            frame["doc_id"] = frame["doc_id"].astype("Int64")
            yield frame

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(split, "doc_id long, piece int, start long, length long, ids_crc32 long")


class Counts:
    """Open pieces per length, with the searches the reduction needs."""

    def __init__(self, counts: dict[int, int]) -> None:
        self.n = {w: c for w, c in counts.items() if c > 0}
        self.sizes = sorted(self.n)

    def take(self, size: int, many: int) -> None:
        self.n[size] -= many
        if not self.n[size]:
            del self.n[size]
            self.sizes.remove(size)

    def without(self, *used: int) -> dict[int, int]:
        left = dict(self.n)
        for u in used:
            left[u] -= 1
        return left

    def smallest(self, many: int, left: dict[int, int]) -> list[int]:
        out: list[int] = []
        for w in self.sizes:
            out += [w] * min(left.get(w, 0), many - len(out))
            if len(out) == many:
                break
        return out

    def largest_fit(self, room: int, left: dict[int, int]) -> int | None:
        for i in range(bisect_right(self.sizes, room) - 1, -1, -1):
            if left.get(self.sizes[i], 0) > 0:
                return self.sizes[i]
        return None


def best_pair(counts: Counts, room: int, left: dict[int, int]) -> tuple[int, int] | None:
    """(a, b), a >= b, of the largest sum that fits the room."""
    best, i, j = None, 0, len(counts.sizes) - 1
    while i <= j:
        b, a = counts.sizes[i], counts.sizes[j]
        fits = left.get(a, 0) > 0 and left.get(b, 0) > 0 and (a != b or left[a] > 1)
        if a + b > room or left.get(a, 0) <= 0:
            j -= 1
        else:
            if fits and (best is None or a + b > sum(best)):
                best = (a, b)
            i += 1
    return best


def dominating(counts: Counts, j: int, capacity: int) -> tuple[int, ...] | None:
    """The lengths that may share j's sequence for good, or None when no rule settles it."""
    room, left = capacity - j, counts.without(j)
    few = counts.smallest(3, left)
    fitting = 0
    while fitting < len(few) and sum(few[: fitting + 1]) <= room:
        fitting += 1
    if fitting == 0:
        return ()
    partner = counts.largest_fit(room, left)
    if partner == room or fitting == 1:
        return (partner,)
    if fitting == 2:
        a, b = best_pair(counts, room, left)
        if partner >= a + b:
            return (partner,)
        if partner == a:
            # every other pair has a member no longer than b, unless two lengths between fit
            left[a] -= 1
            between = [w for w in counts.sizes if b < w <= a and left.get(w, 0) > 0][:2]
            two = between[0] * 2 if between and left[between[0]] > 1 else sum(between) if len(between) == 2 else None
            if two is None or two > room:
                return (a, b)
    return None


def reduce_sets(counts: Counts, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """[(set, times)]: fixes dominating sets, as often as their pieces last, until no length yields one."""
    fixed = []
    progress = True
    while progress:
        progress = False
        for j in sorted(counts.sizes, reverse=True):
            while counts.n.get(j):
                rest = dominating(counts, j, capacity)
                if rest is None:
                    break
                whole = (j, *rest)
                # fixing a set only removes choices, so the rule holds until a member runs out
                times = min(counts.n[w] // whole.count(w) for w in set(whole))
                for w in set(whole):
                    counts.take(w, times * whole.count(w))
                fixed.append((whole, times))
                progress = True
    return fixed


def solve(lengths: dict[int, int], capacity: int = CAPACITY) -> list[Run]:
    """Runs that place every piece; lengths: length -> how many."""
    runs: list[Run] = []
    used: dict[int, int] = dict.fromkeys(lengths, 0)
    sequences = 0

    def place(length: int, many: int, first: int, per: int, offset: int) -> None:
        runs.append((length, used[length], many, first, per, offset))
        used[length] += many

    counts = Counts(lengths)
    for whole, times in reduce_sets(counts, capacity):
        offset = 0
        for w in whole:
            place(w, times, sequences, 1, offset)
            offset += w
        sequences += times
    # best fit, longest first; open sequences of equal room are kept as ranges
    rooms: list[int] = []
    ranges: dict[int, list[tuple[int, int]]] = {}

    def add(room: int, first: int, many: int) -> None:
        if many and room:
            if room not in ranges:
                rooms.insert(bisect_left(rooms, room), room)
            ranges.setdefault(room, []).append((first, many))

    for w in sorted(counts.n, reverse=True):
        open_pieces = counts.n[w]
        while open_pieces:
            at = bisect_left(rooms, w)
            if at < len(rooms):
                room = rooms[at]
                first, many = ranges[room].pop()
                if not ranges[room]:
                    del ranges[room]
                    rooms.pop(at)
            else:
                room, first, many = capacity, sequences, -(-open_pieces // (capacity // w))
                sequences += many
            per = room // w
            full = min(many, open_pieces // per)
            offset = capacity - room
            if full:
                place(w, full * per, first, per, offset)
                open_pieces -= full * per
                add(room - per * w, first, full)
            if full < many and open_pieces:
                place(w, open_pieces, first + full, per, offset)
                add(room - open_pieces * w, first + full, 1)
                open_pieces, full = 0, full + 1
            add(room, first + full, many - full)
    return runs


def numbered(rows: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """rows with ``number``: 0, 1, ... within each length, counted in hash buckets."""
    buckets = max(1, -(-rows.count() // bucket_rows))
    order = ["doc_id", "piece", "start", "ids_crc32"]
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", "row"), F.lit(buckets)))
    sums = rows.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("length", "bucket", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("length", "bucket").orderBy(*order, "row")
    return rows.withColumn("_in", F.row_number().over(inside) - 1).join(sums, ["length", "bucket"]).withColumn("number", F.col("_before") + F.col("_in"))


def pack(docs: DataFrame, vocabulary: dict[str, str] | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) per piece of docs(doc_id, text)."""
    spark = docs.sparkSession
    rows = cut_lineage(pieces(docs, vocabulary or default_vocabulary(), capacity, end_id).withColumn("row", F.monotonically_increasing_id()))
    lengths = {int(r["length"]): int(r["n"]) for r in rows.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most ``capacity`` rows
    plan: dict[int, list[np.ndarray]] = {}
    for length, group in pd.DataFrame(solve(lengths, capacity), columns=["length", "first", "many", "sequence", "per", "at"]).groupby("length"):
        group = group.sort_values("first")
        plan[int(length)] = [group[c].to_numpy(np.int64) for c in ("first", "sequence", "per", "at")]
    shared = spark.sparkContext.broadcast(plan)  # bounded by the number of lengths, not of documents

    @F.pandas_udf("sequence_id long, offset long")
    def look_up(length: pd.Series, number: pd.Series) -> pd.DataFrame:
        w, n = length.to_numpy(), number.to_numpy()
        out = np.zeros((len(n), 2), dtype=np.int64)
        for size in np.unique(w):
            first, sequence, per, at = shared.value[int(size)]
            own = np.flatnonzero(w == size)
            run = np.searchsorted(first, n[own], side="right") - 1
            inside = n[own] - first[run]
            out[own, 0] = sequence[run] + inside // per[run]
            out[own, 1] = at[run] + inside % per[run] * size
        return pd.DataFrame(out, columns=["sequence_id", "offset"])

    placed = numbered(rows).withColumn("_at", look_up("length", "number"))
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "_at.sequence_id", "_at.offset")
