"""Main text of web pages by union-free wrappers of their hosts.

A page becomes a tree of elements. A wrapper is a tree too: every node carries a quantifier
(once, optional, repeated, both) and a text part that is a constant or a slot, which makes it
a union-free regular expression over the token stream. Wrappers grow by alignment: children
of two nodes are aligned by their keys, aligned ones are merged, the others become optional;
neighbouring copies of a child, or of a run of two or three children, become one repeated
group; texts that differ turn a constant into a slot. Alignment starts inside each task, and
partial wrappers of a host are merged in two steps, so a host with many pages is never
gathered page by page.

A page is then read along its host's wrapper. Text counts when it stands in the content
part (all articles that are not comments, teasers or adverts by class, else all outermost main
elements, else all outermost blocks with a content class, else what the wrapper shows to hold
the most slot text) and not in an element for other ends (by name or class) or a list of links.
Some class words name furniture on one page and content on another (a menu of dishes, a heading
on search): inside the content part the wrapper decides on them, and such an element stays
unless it is a list of links or the host's pages share its text. Where no element marks the content part, a text
that the wrapper found constant over at least ``CONSTANT_PAGES`` different pages is left out
too, if other texts of the host vary.

Defined results: null or empty html has the text ""; broken markup is read as far as it goes
(an unclosed element ends with its parent); a page without a host uses the wrapper of its
kind; rows that repeat a page of a host count once; an empty table gives no rows. Texts keep all
blocks in order; nothing is capped. A wrapper describes the ``DEPTH`` outer levels of a page;
what is nested deeper is read by names and classes alone.
"""

from __future__ import annotations

import html as entities
import json
import re
from collections.abc import Iterator
from difflib import SequenceMatcher

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arborframe.lineage import cut_lineage

CONSTANT_PAGES = 5
#: Hosts a task holds at once while it aligns; then their partial wrappers are passed on.
HELD_HOSTS = 2000
SALTS = 32
#: Largest table of page hashes that is broadcast; beyond it the same join is shuffled.
BROADCAST_ROWS = 1_000_000
#: Levels of elements a wrapper describes.
DEPTH = 100
#: Share of text in links from which a wrapper node is a menu.
LINK_SHARE = 0.8

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']+|\"[^\"]*\"|'[^']*')*+)>|([^<]+|<)", re.S)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
#: A slash at the end that belongs to a value without quotes, as in ``<a href=/>``.
UNQUOTED_END = re.compile(r"=\s*[^\s\"'=]+\Z")
# Fixed values of the markup language.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCKS - {"td", "th", "tr", "tbody", "thead", "tfoot", "caption", "html", "body", "li", "dd", "dt"}
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
OTHER_ENDS = frozenset("nav footer aside form script style noscript template iframe svg button select input textarea dialog menu head title object canvas audio video".split())
OTHER_WORDS = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|sponsor\w*|promo\w*|banner|sidebar|side-?bar|menu|nav|navbar|navigation|breadcrumbs?|cookies?|consent|notice|notification|alert|popup|modal|overlay|newsletter|subscribe|subscription|signup|login|search|share|sharing|social|related|recommended|teaser|comments?|commentlist|respond|replies|reply|disqus|footer|header|masthead|topbar|toolbar|widget|pagination|pager|legal|copyright|disclaimer|tags?|toc)(?=$|[\s_-])",
    re.I,
)
# Words of OTHER_WORDS that also mark content inside an article.
EITHER_WORDS = frozenset("menu search legal header".split())
# First parts of the class words of articles that are no main text.
OTHER_ARTICLES = frozenset("ad ads advert advertisement comment comments promo promoted recommended related reply replies respond response sponsored teaser widget".split())
CONTENT_WORDS = re.compile(r"(?:^|[\s_-])(?:article|post|entry|content|main|story|body-?text|article-?body|post-?body)(?:$|[\s_-])", re.I)


class Node:
    __slots__ = ("tag", "key", "marks", "hidden", "kids")

    def __init__(self, tag: str, attributes: str = "") -> None:
        found = {k.lower(): a or b or c for k, a, b, c in ATTRIBUTE.findall(attributes)} if attributes.strip() else {}
        self.tag, self.kids = tag, []
        self.marks = f"{found.get('class', '')} {found.get('id', '')}".strip()
        role = found.get("role", "")
        style = found.get("style", "").replace(" ", "").lower()
        self.hidden = "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in style or role in ("navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert")
        if role == "main":
            self.tag = "main"
        self.key = self.tag + ("." + re.sub(r"\d+", "0", self.marks.split(" ")[0]) if self.marks else "")


def parse(page: str) -> Node:
    """The element tree of a page; comments and the inside of scripts and the like are left out."""
    root = Node("#page")
    stack, at = [root], 0
    while at < len(page):
        m = TOKEN.match(page, at)
        if m is None:
            break
        at = m.end()
        closing, tag, attributes, text = m.groups()
        if text is not None:
            stack[-1].kids.append(text)
        elif tag is not None:
            tag = tag.lower()
            if closing:
                for depth in range(len(stack) - 1, 0, -1):
                    if stack[depth].tag == tag:
                        del stack[depth:]
                        break
                    if stack[depth].tag in ("article", "main", "body") and tag not in ("body", "html", "main", "article", "div", "section"):
                        break
                continue
            if tag in CLOSES_P:
                _close(stack, {"p"}, BLOCKS - {"p"})
            elif tag in SIBLINGS:
                _close(stack, SIBLINGS[tag], {"ul", "ol", "dl", "table", "menu"})
            node = Node(tag, attributes)
            stack[-1].kids.append(node)
            if tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
                at = end.end() if end else len(page)
            elif tag not in VOID and not (attributes.endswith("/") and not UNQUOTED_END.search(attributes)):
                stack.append(node)
    return root


def _close(stack: list[Node], tags: set[str], until: frozenset | set) -> None:
    """End the nearest open element of ``tags`` unless one of ``until`` is open inside its parent."""
    for depth in range(len(stack) - 1, 0, -1):
        if stack[depth].tag in tags:
            del stack[depth:]
            return
        if stack[depth].tag in until:
            return


def other_article(node: Node) -> bool:
    """Whether an article is a reader comment, a teaser or an advert by the first part of a class word."""
    return node.tag == "article" and any(re.split(r"[-_]", w.lower())[0] in OTHER_ARTICLES for w in node.marks.split())


def other_end(node: Node, in_content: bool, known: list | None = None) -> bool:
    """Whether an element serves another end than the main text, by its name or marks."""
    if node.hidden or node.tag in OTHER_ENDS or (node.tag == "header" and not in_content):
        return True
    if not node.marks or node.tag in ("html", "body", "main"):
        return False
    if node.tag == "article":
        return other_article(node)
    words = {w.strip(" \t\n\r\f-_").lower() for w in OTHER_WORDS.findall(node.marks)}
    if not words or not (in_content and words <= EITHER_WORDS) or shared(known):
        return bool(words)
    length, linked = text_below(node, False)
    return linked >= LINK_SHARE * length


# A wrapper node is a list: [key, pages, optional, repeated, text, length, link length, children].
# text: None, a constant (its hash and length), or "*" for a slot.
KEY, PAGES, OPTIONAL, REPEATED, TEXT, LENGTH, LINKED, KIDS = range(8)


def of_page(node: Node, in_link: bool = False, depth: int = 0) -> list:
    """The wrapper that describes exactly one page, down to ``DEPTH`` levels."""
    own = own_text(node)
    size = int(own.partition(":")[0]) if own else 0
    in_link = in_link or node.tag == "a"
    if depth == DEPTH:
        below, linked = text_below(node, in_link)
        return [node.key, 1, False, False, own, below, linked, []]
    kids = fold([of_page(k, in_link, depth + 1) for k in node.kids if isinstance(k, Node) and k.tag not in ("head", "br")])
    length = size + sum(k[LENGTH] for k in kids)
    linked = size * in_link + sum(k[LINKED] for k in kids)
    return [node.key, 1, False, False, own, length, linked, kids]


def text_below(node: Node, in_link: bool) -> tuple[int, int]:
    """Length of the text of an element and all below it, and how much of that is in links."""
    length, linked, left = 0, 0, [(node, in_link)]
    while left:
        at, link = left.pop()
        size = len(" ".join(" ".join(k for k in at.kids if isinstance(k, str)).split()))
        length, linked = length + size, linked + size * link
        left += [(k, link or k.tag == "a") for k in at.kids if isinstance(k, Node)]
    return length, linked


def merge_text(a: str | None, b: str | None) -> str | None:
    if a is None or b is None:
        return a or b
    return a if a == b else "*"


def join(a: list, b: list, pages: bool) -> list:
    """One node for two that stand at the same place: of two pages, or copies within a page."""
    if pages:
        kids = align(a[KIDS], b[KIDS])
    else:
        kids = align(a[KIDS], b[KIDS], one_page=True)
    count = a[PAGES] + b[PAGES] if pages else max(a[PAGES], b[PAGES])
    return [a[KEY], count, a[OPTIONAL] or b[OPTIONAL], a[REPEATED] or b[REPEATED], merge_text(a[TEXT], b[TEXT]), a[LENGTH] + b[LENGTH], a[LINKED] + b[LINKED], kids]


def align(a: list, b: list, one_page: bool = False) -> list:
    """Children of two nodes in one order; what only one side has becomes optional."""
    ka, kb = [k[KEY] for k in a], [k[KEY] for k in b]
    if ka == kb:
        return [join(x, y, not one_page) for x, y in zip(a, b)]
    out: list = []
    for op, i1, i2, j1, j2 in SequenceMatcher(None, ka, kb, autojunk=False).get_opcodes():
        if op == "equal":
            out += [join(x, y, not one_page) for x, y in zip(a[i1:i2], b[j1:j2])]
        else:
            for k in a[i1:i2] + b[j1:j2]:
                k[OPTIONAL] = True
                out.append(k)
    return fold(out)


def fold(kids: list) -> list:
    """Neighbouring copies of a run of one to three children become one repeated run."""
    for width in (1, 2, 3):
        out: list = []
        i = 0
        while i < len(kids):
            run = kids[i : i + width]
            keys = [k[KEY] for k in run]
            i += width
            copies = 0
            while len(run) == width and [k[KEY] for k in kids[i : i + width]] == keys:
                run = [join(x, y, False) for x, y in zip(run, kids[i : i + width])]
                copies += 1
                i += width
            if copies:
                for k in run:
                    k[REPEATED] = True
                out += run
            else:
                out.append(run[0])
                i -= width - 1
        kids = out
    return kids


def own_text(node: Node) -> str | None:
    """The mark of a node's own text that a wrapper keeps as long as the text is constant."""
    own = " ".join(" ".join(k for k in node.kids if isinstance(k, str)).split())
    return f"{len(own)}:{xxhash.xxh64_hexdigest(own.encode('utf-8', 'surrogatepass'))}" if own else None


def places_of(known: list | None) -> dict[str, list[list]]:
    """The places a wrapper node offers to children, by key."""
    out: dict[str, list[list]] = {}
    for k in known[KIDS] if known else ():
        out.setdefault(k[KEY], []).append(k)
    return out


def place_of(kid: Node, places: dict[str, list[list]]) -> list | None:
    """The place of a child by its key: of several that with its constant text, else a slot, then the
    one with most of its children's keys."""
    offered = places.get(kid.key)
    if not offered:
        return None
    if len(offered) > 1:
        text, inner = own_text(kid), {k.key for k in kid.kids if isinstance(k, Node)}
        alike = [k for k in offered if k[TEXT] == text] or [k for k in offered if k[TEXT] == "*"] or offered
        return max(alike, key=lambda k: len(inner & {c[KEY] for c in k[KIDS]}))
    return offered[0]


def varies(known: list | None) -> bool:
    """Whether a wrapper has a text that differs between the copies or pages it stands for."""
    return known is not None and (known[TEXT] == "*" or any(map(varies, known[KIDS])))


def shared(known: list | None) -> bool:
    """Whether the text of a place is the same on all of ``CONSTANT_PAGES`` or more different pages."""
    return known is not None and known[PAGES] >= CONSTANT_PAGES and not varies(known)


def excluded_by_wrapper(kid: Node, known: list | None, constant: bool) -> bool:
    """A list of links, or, with ``constant``, a text that all pages of the host share word for word."""
    if known is None:
        return False
    if constant and kid.tag in BLOCKS and not known[REPEATED] and known[PAGES] >= CONSTANT_PAGES and not known[KIDS] and known[TEXT] not in (None, "*") and known[TEXT] == own_text(kid):
        return True
    return known[LENGTH] > 0 and known[LINKED] / known[LENGTH] >= LINK_SHARE and known[KEY].split(".")[0] in ("ul", "ol", "div", "section", "p", "table", "td")


def blocks(node: Node, known: list | None, in_content: bool, constant: bool) -> list[str]:
    """Text blocks below a node in page order; ``constant``: without texts that all pages share."""
    out, parts = [], []

    def flush() -> None:
        text = " ".join(entities.unescape("".join(parts)).split())
        if text:
            out.append(text)
        parts.clear()

    # open elements: children still to read, their places in the wrapper, whether a block ends here
    opened = [(iter(node.kids), places_of(known), True)]
    while opened:
        kids, places, block = opened[-1]
        kid = next(kids, None)
        if kid is None:
            opened.pop()
            if block:
                flush()
        elif isinstance(kid, str):
            parts.append(kid)
        elif kid.tag == "br":
            parts.append(" ")
        else:
            own = place_of(kid, places)
            block = kid.tag in BLOCKS
            if block:
                flush()
            if not (other_end(kid, in_content, own) or excluded_by_wrapper(kid, own, constant)):
                opened.append((iter(kid.kids), places_of(own), block))
    return out


def content_parts(root: Node, known: list | None) -> list[tuple[Node, list | None, bool]]:
    """The elements that hold the main text, with their places in the wrapper and whether the
    page marks them as content."""
    found: dict[str, list] = {"article": [], "main": [], "marked": []}
    opened = [(iter(root.kids), places_of(known), frozenset())]
    while opened:
        kids, places, inside = opened[-1]
        kid = next(kids, None)
        if kid is None:
            opened.pop()
        elif isinstance(kid, Node) and not other_end(kid, False):
            kind = kid.tag if kid.tag in ("article", "main") else "marked" if kid.tag in ("div", "section") and CONTENT_WORDS.search(kid.marks) else None
            own = place_of(kid, places)
            if kind and kind not in inside:
                found[kind].append((kid, own, True))
            if kind != "article":
                opened.append((iter(kid.kids), places_of(own), inside | {kind}))
    for parts in found.values():
        if parts:
            return [p for p in parts if not excluded_by_wrapper(p[0], p[1], False)] or parts
    body = next((k for k in _elements(root) if k.tag == "body"), root)
    place = known
    for key in ("html", "body"):
        place = next((k for k in (place[KIDS] if place else []) if k[KEY].split(".")[0] == key), place)
    # without marks: down to the part that holds most of the host's unlinked text
    node = body
    while place:
        best = max(place[KIDS], key=lambda k: k[LENGTH] - k[LINKED], default=None)
        here = [k for k in node.kids if isinstance(k, Node) and best is not None and k.key == best[KEY]]
        if best is None or len(here) != 1 or best[KEY].split(".")[0] not in ("div", "section", "td", "table", "tr", "tbody") or best[LENGTH] - best[LINKED] < 0.7 * (place[LENGTH] - place[LINKED]):
            break
        node, place = here[0], best
    return [(node, place, False)]


def _elements(node: Node) -> Iterator[Node]:
    """All elements below a node in page order."""
    opened = [iter(node.kids)]
    while opened:
        kid = next(opened[-1], None)
        if kid is None:
            opened.pop()
        elif isinstance(kid, Node):
            yield kid
            opened.append(iter(kid.kids))


def main_text(page: str | None, known: list | None) -> str:
    """The main text of one page read along its host's wrapper."""
    if not page:
        return ""
    root = parse(page)
    found = content_parts(root, known)
    constant = not found[0][2] and varies(known)
    parts = [b for node, place, _ in found for b in blocks(node, place, True, constant)]
    if not parts:
        parts = blocks(root, known, False, varies(known))
    if not parts:  # every article is marked as something else: those are all the page has
        parts = [b for e in _elements(root) if other_article(e) for b in blocks(e, None, True, False)]
    return "\n\n".join(parts)


def host_of(url):
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]+)", 1)), F.lit(""))


def wrappers(pages: DataFrame) -> DataFrame:
    """(host, wrapper as text) inferred from all different pages of pages(url, html)."""

    def infer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, list] = {}

        def passed() -> pd.DataFrame:
            frame = pd.DataFrame({"host": list(held), "wrapper": [json.dumps(w) for w in held.values()]})
            held.clear()
            return frame

        for batch in batches:
            for host, page in zip(batch["host"], batch["html"]):
                if page:
                    new = of_page(parse(page))
                    held[host] = join(held[host], new, True) if host in held else new
                    if len(held) >= HELD_HOSTS:
                        yield passed()
        if held:
            yield passed()

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        found = None
        for text in sorted(group["wrapper"]):
            found = json.loads(text) if found is None else join(found, json.loads(text), True)
        return pd.DataFrame({"host": [group["host"].iloc[0]], "wrapper": [json.dumps(found)]})

    keyed = pages.select(host_of(F.col("url")).alias("host"), "html").withColumn("h", F.xxhash64("html"))
    twice = cut_lineage(keyed.groupBy("host", "h").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("host", "h"))
    marked = F.broadcast(twice) if twice.count() <= BROADCAST_ROWS else twice
    # only pages that are there twice are shuffled as texts
    once = keyed.join(marked, ["host", "h"], "left_anti").select("host", "html")
    once = once.unionByName(keyed.join(marked, ["host", "h"], "left_semi").dropDuplicates(["host", "h"]).select("host", "html"))
    partial = once.mapInPandas(infer, "host string, wrapper string")
    salted = partial.withColumn("salt", F.pmod(F.xxhash64("wrapper"), F.lit(SALTS))).groupBy("host", "salt").applyInPandas(lambda g: merge(g), "host string, wrapper string")
    return salted.groupBy("host").applyInPandas(lambda g: merge(g), "host string, wrapper string")


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) per row of pages(page_id, url, html)."""
    known = cut_lineage(wrappers(pages))

    @F.pandas_udf("string")
    def text_of(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        memo: dict[str, list] = {}
        for pages_, wrapper in batches:
            out = []
            for page, text in zip(pages_, wrapper):
                if text is not None and text not in memo:
                    if len(memo) >= HELD_HOSTS:
                        memo.clear()
                    memo[text] = json.loads(text)
                out.append(main_text(page, memo.get(text)))
            yield pd.Series(out, dtype=object)

    rows = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("_host")).join(known.withColumnRenamed("host", "_known"), F.col("_host") == F.col("_known"), "left")
    return rows.select("page_id", "url", text_of("html", "wrapper").alias("text")).withColumn("n_chars", F.length("text").cast("long"))
