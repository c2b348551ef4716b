"""Prefix trie, structure repair and piece encoding against brute force."""

import hashlib
import heapq
import random
import zlib
from collections import defaultdict

import pytest
import sentencepiece

from arborframe.llm import prefixtrie, repair, sentencepieces

TURNS = "conv_id long, turn long, role string, text string, key string, _kid int"


def null_first(value):
    return (value is not None, value)


@pytest.fixture(scope="module")
def conversations(spark):
    rng = random.Random(5)
    said = ["Yes.", "No?", "", " \t", "and so on", None, "end.\n ", "¿Qué? 龘"]
    rows = []
    for c in [*range(0, 40), *range(100, 130), *range(205, 230), -3, 10**12]:
        for t in range(rng.choice([1, 2, 3, 4, 6, 8])):
            rows.append((c, t if rng.random() < 0.95 else t + 2, rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, ""]), rng.choice(said)))
    for c in (300, 301, 302):
        rows += [(c, t, ("user", "assistant")[t % 2], f"{t}.") for t in range(90)]
    rows += [(400 + k, t, "user", "the same.") for k in range(30) for t in range(5)]
    rows += [(7, None, "user", "no turn."), (9, 1, "user", "twice."), (9, 1, "user", "twice.")]
    rows = [(*r, "x", 9) for r in rows]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, TURNS).cache()


def brute_trie(rows):
    own = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            own[c].append((null_first(t), role or "", text or ""))
    own = {c: [(r, x) for _, r, x in sorted(v)] for c, v in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(abs(c) % 100 * (1 if c >= 0 else -1))
        built[c] = own.get(base, [])[:h] + turns[h:]
    members = defaultdict(set)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].add(c)
    out = []
    for path, convs in members.items():
        below = [p for p in members if p[: len(path)] == path]
        kids = [p for p in below if len(p) == len(path) + 1]
        leaves = [p for p in below if not any(len(q) == len(p) + 1 and q[: len(p)] == p for q in below)]
        ends = sorted(c for c in convs if len(built[c]) == len(path))
        out.append(
            (min(convs), len(path), min(members[path[:-1]]) if path else None, len(convs), len(kids), len(leaves),
             sum((len(members[p]) - 1) * len(p[-1][1]) for p in below if p), hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest())
        )
    return sorted(out, key=str)


@pytest.mark.parametrize("group_turns", [prefixtrie.GROUP_TURNS, 20])
def test_trie_matches_brute_force(conversations, group_turns):
    rows = [tuple(r)[:4] for r in conversations.collect() if r.conv_id not in (300, 301, 302) or r.turn < 21]
    long_ones = conversations.filter("conv_id NOT IN (300, 301, 302) OR turn < 21")
    got = prefixtrie.shared_head_trie(long_ones, group_turns)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_trie(rows)


def test_trie_of_several_blocks_without_turns_and_without_rows(spark, conversations):
    three = prefixtrie.conversation_trie(conversations.filter("conv_id BETWEEN 300 AND 302")).collect()
    assert sorted((r.depth, r.conv_id, r.n_convs, r.n_leaves) for r in three) == [(d, 300, 3, 1) for d in range(91)]
    assert sum(r.ends_sha256 == hashlib.sha256(b"300,301,302").hexdigest() for r in three) == 1
    empty = spark.createDataFrame([], TURNS)
    assert prefixtrie.shared_head_trie(empty).count() == 0
    # conversation 8 keeps its turns after the first h and has no family head: nothing is left of it
    one = spark.createDataFrame([(8, 0, "user", "a", "x", 1), (None, 0, "user", "b", "x", 1)], TURNS)
    assert zlib.crc32(b"8") % 6 > 0
    assert [tuple(r)[:6] for r in prefixtrie.shared_head_trie(one).collect()] == [(8, 0, None, 1, 0, 1)]


def brute_repair(rows):
    """Least cost and audit by a best-first search over (cost, audit) strings, and the repaired turns."""
    queue, done = [(0, "", 0, "", ())], set()
    while queue:
        cost, audit, i, state, out = heapq.heappop(queue)
        if i == len(rows) and state in ("", "a"):
            return cost, audit, out
        if (cost, audit, i, state) in done or len(out) > 2 * len(rows) + 3:
            continue
        done.add((cost, audit, i, state))
        give = "assistant" if state == "u" else "user"
        heapq.heappush(queue, (cost + 2, audit + "I", i, give[0], (*out, (give, ""))))
        if i < len(rows):
            role, text, must_go, cut = rows[i]
            heapq.heappush(queue, (cost + 3, audit + "D", i + 1, state, out))
            if not must_go:
                heapq.heappush(queue, (cost + 2 + cut, audit + "R", i + 1, give[0], (*out, (give, text))))
                if role and state + role[:1] in ("s", "u", "su", "ua", "au"):
                    heapq.heappush(queue, (cost + cut, audit + "K", i + 1, role[:1], (*out, (role, text))))


def brute_report(rows):
    convs = defaultdict(list)
    for c, t, role, text in rows:
        convs[c]
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if k == 1 else text.translate(dict.fromkeys(map(ord, ".!?"))) if k == 2 else text
        role = "user" if k == 4 else role
        convs[c] += [(null_first(t), role, text)] * {0: 0, 3: 2}.get(k, 1)
    out = []
    for c, turns in convs.items():
        turns.sort(key=lambda r: (r[0], r[1], repair_key(r[1], r[2])))
        seen, marked, counts = set(), [], [0, 0, 0]
        for _, role, text in turns:
            bare = text.rstrip(repair.SPACE)
            fault = 0 if not bare else 1 if (role, text) in seen else 2 if bare[-1] not in ".!?" else 3
            seen.add((role, text))
            if fault < 3:
                counts[fault] += 1
            marked.append((role, text, fault < 2, int(fault == 2)))
        roles = [r[0][:1] for r in marked]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(roles, roles[1:]))
        nums = [t[0][1] for t in turns if t[0][0]]
        gaps = max(nums) - min(nums) + 1 - len(set(nums)) if nums else 0
        cost, audit, fixed = brute_repair(marked)
        out.append((c, gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(f"{r}:{x}" for r, x in fixed).encode()).hexdigest()))
    return sorted(out, key=str)


def repair_key(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]


def test_repair_matches_brute_force(spark, conversations):
    short = conversations.filter("conv_id NOT IN (300, 301, 302)")
    extra = spark.createDataFrame([(None, 3, None, None, "x", 1), (None, None, "user", "a.", "x", 1)], TURNS)
    table = short.unionByName(extra)
    rows = [tuple(r)[:4] for r in table.collect()]
    got = sorted((tuple(r) for r in repair.repair_report(table).collect()), key=str)
    assert got == brute_report(rows)
    assert repair.repair_report(table.limit(0)).count() == 0


def test_repair_of_long_patterns_in_segments(monkeypatch):
    rng = random.Random(2)
    for n in (0, 1, 2, 9, 10, 11, 40):
        for _ in range(40):
            codes = bytes(rng.choice((0, 1)) + 2 * rng.choice((0, 0, 1)) + 4 * rng.randrange(4) if rng.random() < 0.4 else 4 * (2 + i % 2) for i in range(n))
            codes = bytes(c & ~2 if c & 1 else c for c in codes)
            monkeypatch.setattr(repair, "SEGMENT", 4096)
            whole = repair.solve(codes)
            monkeypatch.setattr(repair, "SEGMENT", 3)
            assert repair.solve(codes) == whole
            if n <= 11:
                rows = [("xsua"[c >> 2], "", bool(c & 1), c >> 1 & 1) for c in codes]
                assert brute_repair(rows)[:2] == whole


def test_ranks_order_nodes_by_their_audits():
    codes = bytes([4, 8, 12, 8, 1, 12, 8, 10, 12])
    layers = repair.solve_costs(codes, repair.with_inserts([0, repair.FAR, repair.FAR, 0]))
    letter, ahead = repair.optimal_arcs(codes, layers, True)
    ranks, pointers = repair.rank_paths(letter, ahead)
    paths = [repair.least_path(letter, pointers, v)[0] for v in range(len(letter))]
    assert [sorted(set(paths)).index(p) for p in paths] == ranks.tolist()


def test_repaired_turns_follow_the_pattern(conversations):
    rows = repair.damaged(conversations)
    found = repair.audits(rows)
    roles = defaultdict(str)
    for r in repair.repaired_turns(rows, found).orderBy("conv_id", "pos").collect():
        roles[r.conv_id] += r.role[0]
    assert all(r in ("", "s" + "ua" * (len(r) // 2), "ua" * (len(r) // 2)) for r in roles.values())


def test_pieces_match_the_library(spark):
    rng = random.Random(4)
    letters = "ab c▁  \n\t.é中龘𠮷\x00ﬁ'<s>ing the"
    texts = ["".join(rng.choice(letters) for _ in range(n)) for n in [*range(30), 4000]]
    texts += [None, "", " ", "▁", "<unk></s>", "X" * 50_000, " " * 40_000, "the same", "the same"]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(None, "a b", "x")], "doc_id long, text string, n_tokens string")
    lib = sentencepiece.SentencePieceProcessor(model_file=sentencepieces.default_model())
    got = sentencepieces.round_trip(docs).collect()
    assert len(got) == len(texts) + 1 and all(r.agrees for r in got)
    for r in got:
        text = "a b" if r.doc_id is None else texts[r.doc_id] or ""
        ids = lib.encode(text)
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(lib.decode(ids).encode()).hexdigest()
    tokens = sentencepieces.encoded(docs)
    back = {r.doc_id: r.text for r in sentencepieces.decoded(tokens).collect()}
    assert all(back[i] == (t or "").replace("▁", " ") for i, t in enumerate(texts))
    assert sentencepieces.round_trip(docs.limit(0)).count() == 0


def test_decoding_of_any_ids_matches_the_library():
    pieces = sentencepieces.Pieces(sentencepieces.default_model())
    rng = random.Random(6)
    for _ in range(3000):
        ids = [rng.randrange(rng.choice((3, 262, 32_000))) for _ in range(rng.randrange(9))]
        assert pieces.decode(ids) == pieces.library.decode(ids), ids
