"""Conversation structure repair: cheapest edits by a cost table, least audit by path ranking.

The rows of a conversation, in order, are kept, given another role, deleted, or preceded by
inserted turns, so that the role initials read ``(s?(ua)+)?``. Nodes are (rows consumed, state
of that pattern); an edit is an arc with a cost and an initial (D, I, K, R).

1. Cost table, last row first: the least cost from each node to the end. Arcs that attain it
   are optimal; they form an acyclic graph, since only inserts stay on a row and they cost.
2. Prefix-doubling ranks: round k ranks the nodes by their least audit of 2^k edits, as the
   pair of the ranks of its halves, and doubles the pointers to the node behind it. A node's
   arcs differ in their initials, so the least first edit fixes the next node.
3. The least path is read off by the doubled pointers: 2^k known nodes give the next 2^k.

A conversation's faults are one byte per row (its audit has as many letters, so this is no more
than the result itself), read as a stream sorted by conversation and turn. Costs and ranks are
held for ``SEGMENT`` rows at a time: the costs at the borders of the segments are taken first, last
segment first, then each segment is ranked for itself. Short fault patterns repeat, so their
solutions are remembered. The texts are read in a second stream that replays the audit over
the rows, one at a time. Both streams sort by conversation, which Spark spills to disk.

Defined results: rows without conv_id are one conversation of their own; a null role, text or
turn counts as one space in the damage; turns of equal number are ordered by role and content;
identical rows are interchangeable; an empty table gives no rows; columns other than conv_id,
turn, role and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arborframe.lineage import cut_lineage
from arborframe.llm.prefixtrie import rows_of, table_of

SPACE = " \t\n\x0b\x0c\r"
COST = {"K": 0, "R": 2, "D": 3, "I": 2}
TRUNCATED_COST = 1
LETTERS = "DIKR"
#: States of the pattern: nothing yet, after s, after u, after a. It may end in the first or the last.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
STEP = {(START, "s"): AFTER_S, (START, "u"): AFTER_U, (AFTER_S, "u"): AFTER_U, (AFTER_U, "a"): AFTER_A, (AFTER_A, "u"): AFTER_U}
#: The role that another role or an insert gives in each state, and the state behind it.
GIVEN = {START: ("user", AFTER_U), AFTER_S: ("user", AFTER_U), AFTER_U: ("assistant", AFTER_A), AFTER_A: ("user", AFTER_U)}
ENDS = (START, AFTER_A)
INITIALS = "sua"
FAR = 1 << 60
SEGMENT = 4096
#: Patterns of at most so many rows are solved once per task, the most recent ``REMEMBERED`` of them.
REMEMBERED_ROWS, REMEMBERED = 64, 1 << 16

FOUND = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
FOUND_TYPES = [("conv_id", pa.int64()), *[(n, pa.int64()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")], ("audit", pa.string())]


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copy): rows dropped, emptied, cut, repeated or given role user by a hash of their place."""
    place = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
        (F.crc32(place) % 20).alias("_kind"),
    )
    copies = F.when(F.col("_kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    text = F.when(F.col("_kind") == 1, F.lit("")).when(F.col("_kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return rows.filter("_kind <> 0").select(
        "conv_id", "turn", F.when(F.col("_kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"), text.alias("text"), F.explode(copies).alias("copy")
    )


def content_key() -> Column:
    whole = F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    return F.substring(F.unhex(F.sha2(whole, 256)), 1, 16)


def solve_costs(faults: bytes, end: list[int]) -> list[list[int]]:
    """Least costs per layer and state, last layer first computed from ``end`` (inserts of the last layer included)."""
    layers = [end]
    for fault in reversed(faults):
        after = layers[-1]
        must_go, cut, initial = fault & 1, fault >> 1 & 1, INITIALS[(fault >> 2) - 1] if fault >> 2 else ""
        here = [after[q] + COST["D"] for q in range(4)]
        if not must_go:
            for q in range(4):
                here[q] = min(here[q], after[GIVEN[q][1]] + COST["R"] + cut * TRUNCATED_COST)
                if (q, initial) in STEP:
                    here[q] = min(here[q], after[STEP[q, initial]] + COST["K"] + cut * TRUNCATED_COST)
        layers.append(with_inserts(here))
    return layers[::-1]


def with_inserts(costs: list[int]) -> list[int]:
    """Costs when turns may also be inserted at this layer; two rounds reach every state."""
    for _ in range(2):
        costs = [min(costs[q], costs[GIVEN[q][1]] + COST["I"]) for q in range(4)]
    return costs


def optimal_arcs(faults: bytes, layers: list[list[int]], last: bool) -> tuple[np.ndarray, np.ndarray]:
    """(letter, next node) of the optimal arc with the least initial, per node 4 * layer + state; 0 and the node itself where a path ends."""
    n = len(faults)
    letter, ahead = np.zeros(4 * n + 4, np.int64), np.arange(4 * n + 4, dtype=np.int64)
    for i in range(n + 1 if last else n):
        fault = faults[i] if i < n else 1
        must_go, cut, initial = fault & 1, fault >> 1 & 1, INITIALS[(fault >> 2) - 1] if fault >> 2 else ""
        for q in range(4):
            cost, arcs = layers[i][q], []
            if i < n:
                arcs.append(("D", 4 * (i + 1) + q, layers[i + 1][q] + COST["D"]))
                if not must_go:
                    to = GIVEN[q][1]
                    arcs.append(("R", 4 * (i + 1) + to, layers[i + 1][to] + COST["R"] + cut * TRUNCATED_COST))
                    if (q, initial) in STEP:
                        to = STEP[q, initial]
                        arcs.append(("K", 4 * (i + 1) + to, layers[i + 1][to] + COST["K"] + cut * TRUNCATED_COST))
            to = GIVEN[q][1]
            arcs.append(("I", 4 * i + to, layers[i][to] + COST["I"]))
            best = min(((a, v) for a, v, c in arcs if c == cost), default=None)
            if best is not None and cost < FAR:
                letter[4 * i + q], ahead[4 * i + q] = 1 + LETTERS.index(best[0]), best[1]
    return letter, ahead


def rank_paths(letter: np.ndarray, ahead: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """(ranks, pointers): nodes ranked by their least audit, and the nodes 2^k edits ahead for every k."""
    rank, pointers = letter, [ahead]
    while True:
        _, new = np.unique(rank * (len(rank) + 5) + rank[pointers[-1]], return_inverse=True)
        ahead = pointers[-1][pointers[-1]]
        if np.array_equal(ahead, pointers[-1]):
            return new, pointers
        rank = new
        pointers.append(ahead)


def least_path(letter: np.ndarray, pointers: list[np.ndarray], start: int) -> tuple[str, int]:
    """(audit, last node) from ``start``: the first 2^k nodes of the path give the next 2^k."""
    nodes = np.array([start])
    for ahead in pointers:
        nodes = np.concatenate([nodes, ahead[nodes]])
    return "".join(LETTERS[c - 1] for c in letter[nodes].tolist() if c), int(nodes[-1])


def solve(faults: bytes) -> tuple[int, str]:
    """(cost, audit) of a conversation; a fault byte is 1 for must go, plus 2 for truncated, plus 4 times the place of its initial in ``INITIALS``."""
    pieces = [faults[i : i + SEGMENT] for i in range(0, len(faults), SEGMENT)] or [b""]
    ends = [with_inserts([0 if q in ENDS else FAR for q in range(4)])]
    for piece in reversed(pieces[1:]):
        ends.append(solve_costs(piece, ends[-1])[0])
    cost, audit, state = None, [], START
    for k, piece in enumerate(pieces):
        last = k == len(pieces) - 1
        layers = solve_costs(piece, ends[-1 - k])
        cost = layers[0][START] if cost is None else cost
        letter, ahead = optimal_arcs(piece, layers, last)
        _, pointers = rank_paths(letter, ahead)
        text, node = least_path(letter, pointers, state)
        audit.append(text)
        state = node % 4
    return cost, "".join(audit)


class Faults:
    """Counts and fault bytes of one conversation, fed row by row."""

    def __init__(self, conv_id: int | None) -> None:
        self.conv_id, self.codes = conv_id, bytearray()
        self.low = self.high = self.initial = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0

    def add(self, turn: int | None, initial: str, blank: bool, cut: bool, again: bool) -> None:
        if turn is not None and turn != self.high:
            self.low = turn if self.low is None else self.low
            self.high, self.turns = turn, self.turns + 1
        if self.initial is not None and self.initial + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.initial = initial
        again, cut = again and not blank, cut and not blank and not again
        self.blank, self.duplicate, self.truncated = self.blank + blank, self.duplicate + again, self.truncated + cut
        self.codes.append((blank or again) + 2 * cut + 4 * (INITIALS.index(initial) + 1 if initial and initial in INITIALS else 0))

    def row(self, remembered: Callable[[bytes], tuple[int, str]] = solve) -> tuple:
        codes = bytes(self.codes)
        cost, audit = (remembered if len(codes) <= REMEMBERED_ROWS else solve)(codes)
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit


def audits(rows: DataFrame) -> DataFrame:
    """(conv_id, fault counts, cost, audit) per conversation of rows(conv_id, turn, role, text, copy)."""
    stripped = F.expr(f"trim(TRAILING '{SPACE}' FROM text)")
    slim = rows.select(
        "conv_id", "turn", "role", content_key().alias("key"), "copy", (stripped == "").alias("blank"), (~F.substring(stripped, -1, 1).isin(".", "!", "?")).alias("cut")
    )
    seen = Window.partitionBy("conv_id", "role", "key").orderBy(F.asc_nulls_first("turn"), "copy")
    slim = slim.repartition("conv_id").withColumn("again", F.row_number().over(seen) > 1)
    slim = slim.sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "key", "copy", "again")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, remembered = None, lru_cache(maxsize=REMEMBERED)(solve)
        for batch in batches:
            out = []
            for conv_id, turn, initial, blank, cut, again in rows_of(batch):
                if held is None or conv_id != held.conv_id:
                    if held is not None:
                        out.append(held.row(remembered))
                    held = Faults(conv_id)
                held.add(turn, initial, blank, cut, again)
            yield table_of(out, FOUND_TYPES)
        if held is not None:
            yield table_of([held.row(remembered)], FOUND_TYPES)

    return slim.select("conv_id", "turn", F.substring("role", 1, 1).alias("initial"), "blank", "cut", "again").mapInArrow(find, FOUND)


class Replay:
    """Applies an audit to the rows of a conversation as they come."""

    def __init__(self, audit: str) -> None:
        self.audit, self.at, self.state = audit, 0, START

    def inserted(self) -> Iterator[tuple[str, str, str]]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            role, self.state = GIVEN[self.state]
            self.at += 1
            yield "I", role, ""

    def row(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.state = STEP[self.state, role[:1]]
            yield edit, role, text
        elif edit == "R":
            role, self.state = GIVEN[self.state]
            yield edit, role, text


def replayed(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Rows under their conversation's audit (which comes first), sorted for ``Replay``."""
    plan = found.select("conv_id", F.lit(0).alias("part"), F.lit(None).cast("long").alias("turn"), F.lit(None).cast("string").alias("role"), "audit", F.lit(None).cast("binary").alias("key"), F.lit(0).alias("copy"))
    body = rows.select("conv_id", F.lit(1).alias("part"), "turn", "role", F.col("text").alias("audit"), content_key().alias("key"), "copy")
    both = plan.unionByName(body).repartition("conv_id").sortWithinPartitions("conv_id", "part", F.asc_nulls_first("turn"), "role", "key", "copy")
    return both.select("conv_id", "part", "role", F.col("audit").alias("text"))


def repaired_turns(rows: DataFrame, found: DataFrame) -> DataFrame:
    """(conv_id, pos, edit, role, text): the repaired conversations."""
    types = [("conv_id", pa.int64()), ("pos", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())]

    def turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        replay, conv, pos = None, None, 0
        for batch in batches:
            out = []
            for conv_id, part, role, text in rows_of(batch):
                if part == 0:
                    made = replay.inserted() if replay else ()
                    out += [(conv, pos := pos + 1, *t) for t in made]
                    replay, conv, pos = Replay(text), conv_id, 0
                else:
                    out += [(conv, pos := pos + 1, *t) for t in replay.row(role, text)]
            yield table_of(out, types)
        if replay:
            yield table_of([(conv, pos := pos + 1, *t) for t in replay.inserted()], types)

    return replayed(rows, found).mapInArrow(turns, "conv_id long, pos long, edit string, role string, text string")


def repaired_hashes(rows: DataFrame, found: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256): SHA-256 of ``role:text`` of the repaired turns, joined by newlines."""
    types = [("conv_id", pa.int64()), ("repaired_sha256", pa.string())]

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        replay, conv, state, any_turn = None, None, None, False

        def feed(turns: Iterator[tuple[str, str, str]]) -> None:
            nonlocal any_turn
            for _, role, text in turns:
                state.update((f"\n{role}:{text}" if any_turn else f"{role}:{text}").encode())
                any_turn = True

        for batch in batches:
            out = []
            for conv_id, part, role, text in rows_of(batch):
                if part == 0:
                    if replay:
                        feed(replay.inserted())
                        out.append((conv, state.hexdigest()))
                    replay, conv, state, any_turn = Replay(text), conv_id, hashlib.sha256(), False
                else:
                    feed(replay.row(role, text))
            yield table_of(out, types)
        if replay:
            feed(replay.inserted())
            yield table_of([(conv, state.hexdigest())], types)

    return replayed(rows, found).mapInArrow(hashes, "conv_id long, repaired_sha256 string")


def repair_report(conversations: DataFrame) -> DataFrame:
    """Damage, faults, cost, audit and hash of the repaired text per original conversation."""
    rows = damaged(conversations)
    found = audits(rows)
    every = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct().withColumnRenamed("conv_id", "_conv")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    found = every.join(found, F.col("conv_id").eqNullSafe(F.col("_conv")), "left")
    found = found.select(F.col("_conv").alias("conv_id"), *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts], F.coalesce("audit", F.lit("")).alias("audit"))
    found = cut_lineage(found)
    hashed = repaired_hashes(rows, found).withColumnRenamed("conv_id", "_conv")
    return found.join(hashed, F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv")
