"""Text features shared by the document classifiers.

Every feature is a short string counted over the whole text:

* ``w:`` lower-cased words without edge punctuation, ``p:`` their prefixes of 3 to 7 letters;
* ``s:`` the shape of a word: runs of capitals, small letters, digits kept as A, a, 0, other signs as they are;
* ``r:`` how often a word equals the word before it, ``l:`` how often a line equals an earlier line.

A null text has no features. Labels, languages, sources and ids are never features.
"""

from __future__ import annotations

import re
from collections import Counter

EDGE = "".join(map(chr, range(33, 48))) + ":;<=>?@[\\]^_`{|}~"
PREFIXES = range(3, 8)
_RUNS = ((re.compile(r"[A-ZÀ-ÖØ-Þ]+"), "A"), (re.compile(r"[^\W\d_A-ZÀ-ÖØ-Þ]+"), "a"), (re.compile(r"\d+"), "0"))
#: Entries of a worker's memo of word features; it is emptied when full, which changes no result.
MEMO = 150_000


def shape(token: str) -> str:
    for run, sign in _RUNS:
        token = run.sub(sign, token)
    return token[:12]


def _features(token: str, prefixes: bool) -> list[str]:
    core = token.lower().strip(EDGE)
    out = ["s:" + shape(token)]
    if core:
        out.append("w:" + core[:40])
        if prefixes:
            out += ["p:" + core[:k] for k in PREFIXES if k < len(core)]
    return out


def _whole(text: str, tokens: list[str]) -> list[tuple[str, int]]:
    """Features of the text as a whole."""
    lines = [x for x in text.split("\n") if x and not x.isspace()]
    found = (("r:word", sum(map(str.__eq__, tokens, tokens[1:]))), ("l:line", len(lines) - len(set(lines))), ("n:words", len(tokens)))
    return [(name, n) for name, n in found if n]


def counts(text: str | None, prefixes: bool = True) -> Counter:
    """Feature -> number of times, for one text."""
    tokens = (text or "").split()
    out: Counter = Counter()
    for token, n in Counter(tokens).items():
        for f in _features(token, prefixes):
            out[f] += n
    out.update(dict(_whole(text or "", tokens)))
    return out


class Vocabulary:
    """A chosen set of features; ``vector`` counts only these and skips the rest of a text early."""

    def __init__(self, names: list[str]) -> None:
        self.names = names
        self.index = {f: i for i, f in enumerate(names)}
        self.prefixes = any(f.startswith("p:") for f in names)
        self.memo: dict[str, tuple[int, ...]] = {}

    def _ids(self, token: str) -> tuple[int, ...]:
        if len(self.memo) >= MEMO:
            self.memo.clear()
        index = self.index
        found = self.memo[token] = tuple(index[f] for f in _features(token, self.prefixes) if f in index)
        return found

    def vector(self, text: str | None) -> dict[int, int]:
        """Feature number -> count, over the whole text."""
        out: dict[int, int] = {}
        tokens = (text or "").split()
        memo = self.memo
        for token, n in Counter(tokens).items():
            ids = memo.get(token)
            if ids is None:
                ids = self._ids(token)
            for i in ids:
                out[i] = out.get(i, 0) + n
        for name, n in _whole(text or "", tokens):
            if name in self.index:
                out[self.index[name]] = n
        return out
