"""Cases of the second review: small tables on which the operators once did less than the whole job."""

import random

import corpus_pipeline
import numpy as np

from arborframe.llm import jaccard, simhash, wrapper

WORDS = [f"w{i}" for i in range(400)]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def changed(rng, text, k):
    words = text.split(" ")
    for at in rng.sample(range(len(words)), k):
        words[at] = rng.choice(WORDS)
    return " ".join(words)


def test_near_dedup_keeps_one_of_every_similar_group(spark):
    rng = random.Random(5)
    texts = [prose(rng, rng.randrange(60, 300)) for _ in range(40)]
    texts += [changed(rng, t, max(1, len(t.split(" ")) * k // 200)) for t in texts for k in (1, 2, 4, 6)]
    group = [prose(rng, 120)]
    for _ in range(30):  # a chain of copies of copies beside a common passage
        group.append(changed(rng, group[-1], 2))
    passage = prose(rng, 40)
    texts += group + [f"{passage} {prose(rng, 30)}" for _ in range(30)] + [None, "", " ", "one two", "One  two", "one two three"]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int")
    sets = [set(simhash.shingles(t, 5)) for t in texts]
    label = list(range(len(texts)))
    similar = lambda a, b: a == b or 5 * len(a & b) >= 4 * len(a | b)
    for i in range(len(texts)):
        for j in range(i):
            if similar(sets[i], sets[j]) and label[i] != label[j]:
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    kept = {r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, "").collect()}
    assert kept == set(label)
    assert len(kept) < simhash.keep_first(docs).count()
    assert jaccard.keep_first(docs.limit(0)).count() == 0


def test_near_dedup_links_by_simhash_and_verifies(spark, monkeypatch):
    """Near copies are linked by fingerprints before the prefixes, which then try no pair of a group; a link below the similarity does not stay."""
    rng = random.Random(6)
    base = [prose(rng, 400) for _ in range(20)]
    texts = base + [changed(rng, t, 1) for t in base] + [" ".join([base[0]] * 2), "a b c d", "A  b c d", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    seen, verified = [], jaccard.verified

    def spied(docs, rows, classes, pairs, size):
        out = verified(docs, rows, classes, pairs, size)
        seen.append((pairs.count(), {(r.u, r.v) for r in out.collect()}))
        return out

    monkeypatch.setattr(jaccard, "verified", spied)
    kept = {r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, "").collect()}
    sets = [jaccard.shingle_set(t) for t in texts]
    pair = lambda i, j: tuple(sorted((jaccard.set_hash(sets[i]), jaccard.set_hash(sets[j]))))
    bits = [(simhash.fingerprint(texts[i]) ^ simhash.fingerprint(texts[i + 20])).bit_count() for i in range(20)]
    near = {pair(i, i + 20) for i in range(20) if bits[i] <= 4}
    assert len(near) >= 10 and near <= seen[0][1]
    assert seen[1][0] <= 20 - len(near) + 2
    assert kept == {*range(20), 41, 43}


def extracted(spark, pages):
    rows = wrapper.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
    return {r.page_id: r.text for r in rows}


def test_copies_of_a_page_keep_their_text(spark):
    article = "<body><article><h1>Title</h1><p>Text of the page</p></article>"
    plain = "<body><div><h1>Title</h1><p>Text of the page</p></div>"
    pages = [(k, f"http://a/{k}", article) for k in range(7)] + [(k, f"http://b/{k}", plain) for k in range(10, 17)]
    pages += [(k, f"http://c/{k}", f"{plain}<!-- {k} -->") for k in range(20, 27)]
    assert set(extracted(spark, pages).values()) == {"Title\n\nText of the page"}


def test_constant_headings_of_articles_stay(spark):
    page = "<body><article><h1>Title {k}</h1><h2>Summary</h2><p>Text {k}</p></article>"
    texts = extracted(spark, [(k, f"http://a/{k}", page.format(k=k)) for k in range(7)])
    assert texts == {k: f"Title {k}\n\nSummary\n\nText {k}" for k in range(7)}


def test_constant_texts_of_unmarked_pages_go(spark):
    page = "<body><div><h1>Title {k}</h1><p>Follow us</p><blockquote>Text {k}</blockquote></div>"
    texts = extracted(spark, [(k, f"http://a/{k}", page.format(k=k)) for k in range(7)])
    assert all("Follow us" not in t and t.startswith(f"Title {k}\n\nText {k}") for k, t in texts.items())


def test_all_sibling_content_blocks_are_kept(spark):
    page = "<body><div class=post-content><p>First {k}</p><div class=entry><p>Inner {k}</p></div></div><section class=story><p>Second {k}</p></section><div class=promo>x</div>"
    pages = [(k, f"http://a/{k}", page.format(k=k)) for k in range(3)]
    pages += [(9, "http://b/", "<body><div class=post><a href=/x>More news</a></div><div class=post-content><p>Story</p></div>")]
    texts = extracted(spark, pages)
    assert texts == {k: f"First {k}\n\nInner {k}\n\nSecond {k}" for k in range(3)} | {9: "Story"}


def test_short_lines_repeat_exactly(spark):
    docs = spark.createDataFrame([(1, "Share this\nfirst body\n\nles."), (2, "share  this\nsecond body\n\nles.\nles"), (3, "les.\n\nLes.")], "doc_id long, text string")
    got = {r.doc_id: r.text for r in corpus_pipeline.line_dedup(spark, docs, "").collect()}
    assert got == {1: "Share this\nfirst body\n\nles.", 2: "second body\n\nles", 3: ""}


def test_parity_sketches_lose_no_similar_pair():
    rng = np.random.default_rng(8)
    for n in (1, 3, 40, 64, 65, 300, 5000):
        for share in (0.0, 0.05, 0.11, 0.2, 1.0):
            one = np.unique(rng.integers(-(2**62), 2**62, n))
            keep = rng.random(len(one)) >= share
            two = np.unique(np.concatenate([one[keep], rng.integers(-(2**62), 2**62, int(n * share * rng.random()))]))
            both, either = len(np.intersect1d(one, two)), len(np.union1d(one, two))
            room = jaccard.may_be_similar(jaccard.sketch(one), jaccard.sketch(two), len(one), len(two))
            assert room or both * 5 < either * 4
            assert n < 300 or share < 1.0 or not room


def test_sibling_comments_and_teasers_go(spark):
    post = "<article class=post><h1>T{k}</h1><p>main text {k}</p><article class=comment-body><p>inner {k}</p></article></article>"
    others = "<article class='comment even'><p>reader {k}</p></article><article class=teaser><h2>Related</h2><p>promo {k}</p></article>"
    pages = [(k, "http://a/", ("<body>" + post + others).format(k=k)) for k in range(3)]
    pages += [(10, "http://b/", "<main><p>story</p><article class=comment>reader</article></main>"), (11, "http://c/", "<div><p>story</p></div><article id=comment-3>reader</article>")]
    pages += [(12, "http://d/", "<body><article class='promo-story'><p>all there is</p></article>"), (13, "http://e/", "<article class='post tag-comment'><p>story</p></article>")]
    assert extracted(spark, pages) == {k: f"T{k}\n\nmain text {k}" for k in range(3)} | {10: "story", 11: "story", 12: "all there is", 13: "story"}


def test_class_words_with_two_meanings_are_decided_by_the_wrapper(spark):
    page = "<article><div class=entry-header><h1>T{k}</h1></div><h2 class=search>On search {k}</h2><div class=menu><p>Soup {k}</p></div><p class=legal>Law {k}</p><div class='menu sidebar'>side {k}</div><div class=menu><a href=/>Home {k}</a></div><p class=ad>Buy {k}</p></article>"
    want = "T{k}\n\nOn search {k}\n\nSoup {k}\n\nLaw {k}"
    pages = [(k, "http://a/", page.format(k=k)) for k in range(6)] + [(9, "http://b/", page.format(k=9))]
    assert extracted(spark, pages) == {p: want.format(k=p) for p in [*range(6), 9]}
    fixed = "<article><p>Text {k}</p><div class=menu><p>Home About</p></div></article>"
    assert extracted(spark, [(k, "http://a/", fixed.format(k=k)) for k in range(6)]) == {k: f"Text {k}" for k in range(6)}


def test_deep_nesting_is_read(spark):
    deep = "<div>" * 3000 + "<p>deep {k}</p>" + "</div>" * 1500 + "<p>less deep {k}</p><a href=/>x</a>"
    pages = [(k, "http://a/", "<body><article>" + deep.format(k=k)) for k in range(3)] + [(k, "http://b/", "<body>" + deep.format(k=k)) for k in range(5, 8)]
    pages += [(9, "http://c/", "<article>" + "<p>word " * 200_000)]
    got = extracted(spark, pages)
    assert {k: t for k, t in got.items() if k < 9} == {k: f"deep {k}\n\nless deep {k}\n\nx" for k in (0, 1, 2, 5, 6, 7)}
    assert got[9].count("word") == 200_000


def test_extraction_ignores_extra_columns(spark):
    pages = spark.createDataFrame([(1, "http://a/", "<p>x", "t", "h", 3)], "page_id long, url string, html string, text string, host string, _host int")
    assert [(r.page_id, r.text) for r in wrapper.extract(pages).collect()] == [(1, "x")]


def test_the_order_of_shingles_counts_all_documents(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "SAMPLE_DOCS", 1, raising=False)  # a sample of one document in 32, as of a large table
    passage = " ".join(f"shared{k}" for k in range(9))
    texts = [f"{passage} " + " ".join(f"own{i}w{k}" for k in range(30)) for i in range(24)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    common = set(jaccard.shingle_set(passage).tolist())
    rows = jaccard.with_prefix(docs).collect()
    assert len(rows) == 24 and all(len(r.prefix) == 8 and not common & set(r.prefix) for r in rows)
    # the order is the same however documents are dealt
    again = {r.doc_id: r.prefix for r in jaccard.with_prefix(docs.repartition(7)).collect()}
    assert again == {r.doc_id: r.prefix for r in rows}
