"""The operators against brute force on small tables, with nulls, blanks, ties and repeated rows."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from arborframe.llm import capfilter, editprint, linededup, mixing, packing, quality, simhash, toxicity, warc, wrapper

DOCS = "doc_id long, text string, source string, fp string, row long, size int"
WORDS = [f"w{i}" for i in range(400)]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    base = [prose(rng, rng.randrange(20, 90)) for _ in range(60)]
    near = [b.replace(" ", "  ", 1) for b in base[:5]]
    return base + near + base[:6] + [None, "", " \t\n", "one", "X" * 60_000]


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, ("a", "b", None)[i % 3], "x", 9, 9) for i, t in enumerate(texts)]
    rows += [rows[3], (None, texts[1], "a", "x", 9, 9), (None, None, None, "x", 9, 9)]
    return spark.createDataFrame(rows, DOCS).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def components(n, linked):
    lab = list(range(n))

    def find(i):
        while lab[i] != i:
            i = lab[i]
        return i

    for i in range(n):
        for j in range(i):
            if linked(i, j):
                a, b = find(i), find(j)
                lab[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def test_simhash_matches_brute_force(spark, docs, empty):
    rows = docs.select("doc_id", "text").collect()
    prints = [simhash.fingerprint(r.text) for r in rows]
    roots = components(len(rows), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 4)
    least = {}
    for r, root in zip(rows, roots):
        if r.doc_id is not None:
            least[root] = min(r.doc_id, least.get(root, r.doc_id))
    want = sorted((str(r.doc_id), f"{p:016x}", str(least[root])) for r, p, root in zip(rows, prints, roots))
    got = sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in simhash.near_duplicates(docs).collect())
    assert got == want
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(roots))
    assert simhash.near_duplicates(empty).count() == 0


def test_pigeonhole_links_are_complete(spark):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 40, dtype=np.int64)
    flips = [int(b) ^ sum(1 << int(k) for k in rng.choice(62, size=d, replace=False)) for b in base for d in range(1, 7)]
    fps = sorted({*map(int, base), *flips})
    got = {(r.u, r.v) for r in simhash.fingerprint_links(spark.createDataFrame([(f,) for f in fps], "fp long")).distinct().collect()}
    mask = (1 << 64) - 1
    assert got == {(a, b) for a in fps for b in fps if a < b and ((a ^ b) & mask).bit_count() <= 4}


def test_threshold_allocation_is_optimal():
    costs = [[0, 5, 9, 30], [0, 4, 20, 50], [0, 6, 7, 8]]
    best = min((sum(c[t] for c, t in zip(costs, ts)), ts) for ts in [(a, b, c) for a in range(4) for b in range(4) for c in range(4)] if sum(ts) == 5)
    cost, thresholds = simhash.allocate(costs, 5)
    assert cost == best[0] and sum(t + 1 for t in thresholds) == 5


def test_line_dedup_matches_brute_force(spark, empty):
    rng = random.Random(5)
    lines = [prose(rng, rng.choice((2, 5, 11, 14, 30))) for _ in range(25)]
    edits = []
    for line in lines[:18]:
        w = line.split()
        k = rng.randrange(len(w))
        edits += [" ".join(w[:k] + w[k + 1 :]), " ".join([*w[:k], "zz", *w[k + 1 :]]), " ".join([*w[:k], "yy", *w[k:]]), line.upper(), "  " + line.replace(" ", "\t")]
    pool = lines + edits + ["", " "]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randrange(0, 7)))) for i in range(40)] + [(40, None), (41, "")]
    got = {r.doc_id: r.text for r in linededup.drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    seen, want = [], {}
    for i, text in rows:
        kept = []
        for line in text.split("\n") if text is not None else []:
            w = line.lower().split()
            n = len(w)
            again = n >= 4 and any(w == o or (n >= 10 and len(o) >= 10 and linededup.within_one_edit(w, o)) for o in seen)
            if n >= 4:
                seen.append(w)
            if not again:
                kept.append(line)
        want[i] = None if text is None else "\n".join(kept)
    assert got == want
    assert linededup.drop_repeated_lines(empty).count() == 0


def test_line_dedup_keeps_rows_and_columns(docs):
    out = linededup.drop_repeated_lines(docs)
    assert out.columns == docs.columns and out.count() == docs.count()


def test_mixing_meets_targets(spark, docs, empty):
    got = mixing.taken_words(docs)
    rows = got.collect()
    assert len(rows) == docs.count() and all(r.taken <= 2 * r.size for r in rows)
    assert sorted(map(str, rows)) == sorted(map(str, mixing.taken_words(docs.repartition(3)).collect()))
    total = sum(r.size for r in rows)
    per = got.groupBy("source_size", "target").agg(F.sum("taken").alias("taken")).collect()
    assert sum(p.target for p in per) == pytest.approx(1.5 * total)
    assert all(abs(p.taken - p.target) <= 90 for p in per)
    assert sum(r["count"] for r in mixing.mixed_documents(docs).groupBy("doc_id").count().collect()) == mixing.mix(mixing.draw(docs)).count()
    assert mixing.taken_words(empty).count() == 0 and mixing.mixed_documents(empty).count() == 0


def test_splitting_tree_uses_every_block_once():
    blocks = {0: 50, 1: 7, 2: 1, 3: 0}
    dealt = mixing.shard_quotas(blocks, 6, list(range(6)), 1)
    for source, n in blocks.items():
        got = sorted(p for _, s, first, count in dealt if s == source for p in range(first, first + count))
        assert got == list(range(n))
    assert dealt == [q for shard in range(6) for q in mixing.shard_quotas(blocks, 6, [shard], 1)]


def optimum(lengths, capacity):
    items = sorted((w for w, c in lengths.items() for _ in range(c)), reverse=True)
    best = [len(items)]

    def go(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for k in range(len(bins)):
            if bins[k] + items[i] <= capacity and bins[k] not in bins[:k]:
                go(i + 1, [*bins[:k], bins[k] + items[i], *bins[k + 1 :]])
        go(i + 1, [*bins, items[i]])

    go(0, [])
    return best[0]


def test_reduction_fixes_only_optimal_sets():
    rng = random.Random(2)
    for _ in range(60):
        lengths: dict[int, int] = {}
        for _ in range(rng.randrange(1, 9)):
            w = rng.randrange(2, 21)
            lengths[w] = lengths.get(w, 0) + 1
        counts = packing.Counts(lengths)
        fixed = packing.reduce_sets(counts, 20)
        assert sum(t for _, t in fixed) + optimum(counts.n, 20) == optimum(lengths, 20)


def test_packing_is_gapless_and_whole(docs, empty):
    rows = packing.pack(docs).collect()
    encode = packing.Ids(packing.default_vocabulary()["tokenizer"])
    by_doc = {}
    for r in docs.collect():
        ids = [*encode(r.text or "").tolist(), 2]
        by_doc.setdefault(r.doc_id, []).append(ids)
    for doc_id, versions in by_doc.items():
        want = sorted((k, s, n, zlib.crc32(np.asarray(v[s : s + n], "<u4").tobytes())) for v in versions for k, (s, n) in enumerate(packing.cut(len(v), 1024)))
        assert want == sorted((r.piece, r.start, r.length, r.ids_crc32) for r in rows if r.doc_id == doc_id)
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    assert packing.pack(empty).count() == 0


def test_fast_and_slow_encoders_agree():
    encode = packing.Ids(**packing.default_vocabulary())
    for text in ("a <|endoftext|> b", "naïve café x", "日本 text", "don't  stop\n\n", "\u0085x­"):
        assert encode(text).tolist() == encode.slow.encode(text, add_special_tokens=False).ids


def test_warc_round_trip(spark):
    pages = [(1, "http://a/x", "<p>one</p>"), (2, None, "<p>one</p>"), (3, "http://b/\r\nX: y", None), (4, "u", ""), (5, "u", "a\r\n\r\nWARC/1.1\r\nb é"), (5, "u", "a\r\n\r\nWARC/1.1\r\nb é"), (None, "u", "<p>one</p>")]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = sorted((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.page_records(warc.round_trip(frame)).collect())
    top = {}
    for i, _, h in pages:
        top[h or ""] = max(i or 0, top.get(h or "", 0))
    import base64

    want = []
    for i, _, h in pages:
        raw = (h or "").encode()
        again = top[h or ""] != i
        want.append((str(i), len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if again else "response", top[h or ""] if again else None))
    assert got == sorted(want, key=lambda r: r[:4])
    full = warc.round_trip(frame, with_payload=True).filter("response.type = 'response'")
    assert sorted(bytes(r.response.payload) for r in full.collect()) == sorted((h or "").encode() for i, _, h in pages if top[h or ""] == i)
    assert warc.page_records(warc.round_trip(frame.limit(0))).count() == 0


def test_edit_fingerprints(spark, docs, empty):
    rows = editprint.with_next(docs.filter("doc_id is not null").dropDuplicates(["doc_id"])).collect()
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    ids = sorted(i for i in texts if i is not None)
    assert sorted(r.doc_id for r in rows) == ids
    for r in rows:
        text, following = texts[r.doc_id], texts[ids[(ids.index(r.doc_id) + 1) % len(ids)]]
        changed = editprint.edited(text, following)
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert [r.fingerprint, r.edited_fingerprint] == editprint.fingerprints([text, changed])
        assert r.near_edited == editprint.likeness(r.fingerprint, r.edited_fingerprint)
        assert r.near_next == editprint.likeness(r.fingerprint, editprint.fingerprints([following])[0])
    assert editprint.with_next(docs).count() == docs.count() and editprint.with_next(empty).count() == 0


def test_edit_walk_matches_single_steps():
    jump, digit = editprint.tables()
    text = prose(random.Random(1), 80)
    steps, at = [], 0
    for c in editprint.classes(text):
        here = int(jump[int(c) * editprint.PERIOD + at % editprint.PERIOD])
        steps += [int(c)] * here
        at += here
    chosen = editprint.sampler().steps(len(steps))
    want = f"{len(steps):010x}" + "".join(f"{digit[steps[t] * editprint.PERIOD + t % editprint.PERIOD]:x}" for t in chosen)
    assert editprint.fingerprints([text, "short"])[0] == want


def test_banded_copies_find_near_texts(spark):
    rng = random.Random(9)
    base = [prose(rng, 120) for _ in range(10)]
    near = [b[:-12] + "zzz" for b in base]
    prints = editprint.fingerprints(base + near)
    frame = spark.createDataFrame(list(enumerate(prints)), "doc_id long, fingerprint string")
    assert {(r.doc_id, r.copy_of) for r in editprint.banded_copies(frame).collect()} == {(i + 10, i) for i in range(10)}


def test_cap_filters_match_brute_force(spark):
    rng = np.random.default_rng(4)
    base = rng.standard_normal((150, 16))
    group = base[0] + 0.02 * rng.standard_normal((60, 16))
    x = np.concatenate([base, base[:30] + 0.1 * rng.standard_normal((30, 16)), group, base[:4]]).astype(np.float32)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    odd = [(900, None), (901, []), (902, [0.0] * 16), (903, [float("nan")] * 16), (904, [1.0]), (905, [None] * 16), (None, rows[0][1])]
    frame = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>")
    got = {r.vec_id: r for r in capfilter.near_duplicates(frame, block=20).collect()}
    y = x.astype(float)
    cosine = y @ y.T / np.outer(np.linalg.norm(y, axis=1), np.linalg.norm(y, axis=1))
    roots = components(len(y), lambda i, j: cosine[i, j] >= 0.95)
    want = (cosine >= 0.95).sum(axis=1) - 1
    found = np.array([got[i].n_links for i in range(len(y))])
    assert (found <= want).all() and found.sum() >= 0.98 * want.sum()
    assert sum(got[i].component_id == roots[i] for i in range(len(y))) >= 0.95 * len(y)
    assert all(got[i].n_links == 0 and got[i].component_id == i and got[i].kept for i in range(900, 906)) and got[None].n_links == 0
    assert capfilter.near_duplicates(frame.limit(0)).count() == 0


def test_list_decoding_finds_every_filter():
    words = capfilter.code(12, 20)
    x = np.random.default_rng(0).standard_normal((30, 12))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    full = (x[:, :6] @ words[0].T)[:, :, None] + (x[:, 6:] @ words[1].T)[:, None, :]
    for got, sums in zip(capfilter.decode(x, words, 0.5), full / np.sqrt(2)):
        assert got.tolist() == np.flatnonzero(sums.ravel() >= 0.5).tolist()


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var a="</p>";</script></head><body><header>Site</header><nav><ul><li><a href=/>Home</a><li><a href=/b>B</a></ul></nav>
<div class="sidebar">side</div><div class="{mark}"><h1>Title &amp; {k}</h1><p>First <b>bold</b>
 text {k}<br>more<p>Second &eacute; {k}<div class="ad">buy</div><p>Follow us</div><form>f</form><div id="comments"><p>reader {k}</p></div><footer>&copy; x</footer>"""


def test_extraction(spark):
    pages = [(k, f"http://{h}/{k}", PAGE.format(mark=m, k=k)) for k, (h, m) in enumerate([("a", "post-body")] * 7 + [("b", "c1")] * 7)]
    pages += [(20, "http://a/", None), (21, None, ""), (22, "x", "plain"), (23, "http://c/", "<article><p>a<p>b"), (23, "http://c/", "<article><p>a<p>b")]
    got = wrapper.extract(spark.createDataFrame(pages, "page_id long, url string, html string"))
    texts = {r.page_id: r.text for r in got.collect()}
    assert got.count() == len(pages) and all(r.n_chars == len(r.text) for r in got.collect())
    assert texts[3].startswith("Title & 3\n\nFirst bold text 3 more\n\nSecond é 3")
    assert texts[9].startswith("Title & 9\n\nFirst bold text 9 more\n\nSecond é 9") and "reader" not in texts[9] and "side" not in texts[9]
    assert texts[20] == "" and texts[21] == "" and texts[22] == "plain" and texts[23] == "a\n\nb"
    assert wrapper.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_wrapper_alignment():
    item = "<div>{}</div>"
    a = wrapper.of_page(wrapper.parse("<ul><li>1<li>2</ul>" + item.format("same")))
    b = wrapper.of_page(wrapper.parse("<ul><li>1</ul><p>x</p>" + item.format("same")))
    kids = {k[wrapper.KEY]: k for k in wrapper.join(a, b, True)[wrapper.KIDS]}
    assert kids["p"][wrapper.OPTIONAL] and not kids["div"][wrapper.OPTIONAL]
    assert kids["ul"][wrapper.KIDS][0][wrapper.REPEATED] and kids["div"][wrapper.TEXT] != "*"


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(400):
        toxic, bad = i % 5 == 0, i % 7 == 0
        text = prose(rng, 40) + (" you idiot what scum and trash" if toxic else "")
        rows.append((i, " ".join(w + "###" for w in text.split()) if bad else text))
        labels.append((i, int(not bad), int(toxic)))
    rows += [(900, None), (901, ""), (902, rows[0][1]), (902, rows[0][1])]
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")


@pytest.mark.parametrize(("run", "label", "held"), [(toxicity.toxicity, "toxic", (3, 1)), (quality.quality, "quality", (5, 0))])
def test_classifiers_on_held_out_rows(labelled, run, label, held):
    docs, labels = labelled
    rows = run(docs, labels).collect()
    known = {r.doc_id: r[label] for r in labels.collect() if r[label] is not None}
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % held[0] == held[1]) for r in rows)
    tested = [(r.predicted, known[r.doc_id]) for r in rows if r.held_out and r.doc_id in known]
    assert np.mean([a == b for a, b in tested]) >= 0.9
    assert run(docs, labels.limit(0)).count() == docs.count() and run(docs.limit(0), labels).count() == 0


def test_stages_leave_clashing_columns_alone(spark, labelled):
    rng = random.Random(6)
    names = ["_id", "_hash", "_none", "_row", "_gone", "_times", "_of", "_k", "_pass", "_toxicity", "__id", "id", "text_hash", "pos", "a.b", "n`c"]
    texts = [prose(rng, 30) for _ in range(12)] + ["one\ntwo", "one\nthree", None, ""]
    texts += texts[:3]
    rows = [(i, t, "en", "ab"[i % 2], 0, *[f"{n}{i}" for n in names]) for i, t in enumerate(texts)]
    schema = "doc_id long, text string, lang string, source string, n_chars int, " + ", ".join("`" + n.replace("`", "``") + "` string" for n in names)
    docs = spark.createDataFrame(rows, schema)
    docs_, labels = labelled
    for stage in (linededup.drop_repeated_lines, simhash.keep_first, mixing.mixed_documents, lambda d: toxicity.drop_toxic(d, labels)):
        out = stage(docs)
        assert out.columns == docs.columns
        got = out.collect()
        assert got and all(tuple(r)[5:] == tuple(f"{n}{r.doc_id}" for n in names) for r in got)
