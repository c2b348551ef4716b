"""SentencePiece encoding and decoding of merge-type vocabularies by a score-ordered agenda.

A text is normalised (by the vocabulary's own normaliser), split into characters, and adjacent
symbols are merged as long as their concatenation is a piece: the pair with the highest score
first, the leftmost of equal ones. The agenda is a heap; a pair whose symbols were merged
otherwise in the meantime is skipped. Symbols that are no piece become byte pieces, or the
unknown piece in vocabularies without them.

No piece has a word mark after another character (checked when the vocabulary is read), so no
merge crosses the start of a word and words are merged one by one. Short words repeat, so the
ids of recent ones are remembered.

Decoding joins the surfaces of the pieces: word marks are spaces, the mark that encoding put
before the text is left out, runs of byte pieces are UTF-8 with U+FFFD for every byte that
fits nowhere, the unknown piece is `` ⁇ ``, control pieces are empty.

Arrow batches are checked against the sentencepiece library: the ids of each word when it is
merged, and the decoded text of each row; the column ``agrees`` says so per row. The ids that are
returned are the agenda's.

Defined results: a null text is an empty one and has no ids; special tokens spelled in a text are
ordinary characters; word marks in a text come back as spaces; repeated rows and null ids stay
rows of their own; an empty table gives no rows; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import re
from collections.abc import Iterator
from itertools import chain
from operator import add

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arborframe.llm.prefixtrie import rows_of, table_of

MARK = "▁"
UNKNOWN = " ⁇ "
REMEMBERED = 400_000
SHORT = 32
FAR = float("inf")
#: Rows whose ids are held at once, within an Arrow batch.
SLICE = 64


def each_byte(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�" * (error.end - error.start), error.end


codecs.register_error("arborframe.each_byte", each_byte)


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Pieces:
    """A merge-type vocabulary: encode and decode single texts."""

    def __init__(self, model: str) -> None:
        self.library = sentencepiece.SentencePieceProcessor(model_file=model)
        lib, n = self.library, self.library.vocab_size()
        names = [lib.id_to_piece(i) for i in range(n)]
        if any(lib.is_unused(i) for i in range(n)):
            raise ValueError(f"{model}: unused pieces would have to be split again")
        ordinary = [i for i in range(n) if not (lib.is_byte(i) or lib.is_control(i) or lib.is_unknown(i))]
        self.ids = {names[i]: i for i in ordinary}
        self.scores = {names[i]: -lib.get_score(i) for i in ordinary}
        self.bytes = {int(names[i][3:5], 16): i for i in range(n) if lib.is_byte(i)}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.unknown = lib.unk_id()
        self.surface = [None] * n
        for i in ordinary:
            self.surface[i] = names[i].replace(MARK, " ")
        self.digits = [str(i) for i in range(n)]
        if lib.normalize("a") != f"{MARK}a" or any(re.search(f"[^{MARK}]{MARK}", names[i]) for i in ordinary):
            raise ValueError(f"{model}: merges could cross the start of a word")
        self.runs = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
        self.differing: set[str] = set()
        self.recent: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}

    def merged(self, word: str) -> list[str]:
        """The symbols of a word after all merges; a short word's agenda is a list, whose least entry is the leftmost best pair."""
        if len(word) > SHORT:
            return self.merged_by_heap(word)
        parts, score = list(word), self.scores.get
        agenda = [score(pair, FAR) for pair in map(add, parts, parts[1:])]
        while agenda and (best := min(agenda)) < FAR:
            i = agenda.index(best)
            parts[i] = one = parts[i] + parts.pop(i + 1)
            del agenda[i]
            if i:
                agenda[i - 1] = score(parts[i - 1] + one, FAR)
            if i < len(agenda):
                agenda[i] = score(one + parts[i + 1], FAR)
        return parts

    def merged_by_heap(self, word: str) -> list[str]:
        """The same with the agenda as a heap, for long words."""
        parts, score = list(word), self.scores.get
        n = len(parts)
        ahead, back = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda = [(cost, i, i + 1, 2) for i, pair in enumerate(map(add, parts, parts[1:])) if (cost := score(pair)) is not None]
        heapq.heapify(agenda)
        while agenda:
            _, left, right, size = heapq.heappop(agenda)
            one, two = parts[left], parts[right]
            if not one or not two or len(one) + len(two) != size:
                continue
            parts[left] = one = one + two
            parts[right] = ""
            before, after = back[left], ahead[right]
            ahead[left] = after
            if after < n:
                back[after] = left
                if (cost := score(one + parts[after])) is not None:
                    heapq.heappush(agenda, (cost, left, after, size + len(parts[after])))
            if before >= 0 and (cost := score(parts[before] + one)) is not None:
                heapq.heappush(agenda, (cost, before, left, size + len(parts[before])))
        return [p for p in parts if p]

    def words(self, text: str) -> list[str]:
        """The words of a text; a word's single mark is left out, further marks stay."""
        normal = self.library.normalize(text)
        if MARK * 2 not in normal and normal.startswith(MARK):
            return normal[1:].split(MARK)
        return [run if run.startswith(MARK * 2) else run[1:] for run in self.runs.findall(normal)]

    def word_ids(self, word: str) -> tuple[int, ...]:
        ids: list[int] = []
        for symbol in self.merged(word if word.startswith(MARK) else MARK + word):
            if symbol in self.ids:
                ids.append(self.ids[symbol])
            elif self.bytes:
                ids += [self.bytes[b] for b in symbol.encode()]
            else:
                ids.append(self.unknown)
        return tuple(ids)

    def remember(self, words: list[str]) -> dict[str, tuple[int, ...]]:
        """The ids of words that are not among the recent ones, checked against the library.

        Recent words come in two generations of at most ``REMEMBERED`` words and those of one text.
        """
        fresh = {word: self.older.get(word) for word in words}
        unseen = [word for word, ids in fresh.items() if ids is None]
        spelled = [word[1:].replace(MARK, " ") if word.startswith(MARK) else word for word in unseen]
        for word, theirs in zip(unseen, self.library.encode(spelled, num_threads=1), strict=True):
            fresh[word] = self.word_ids(word)
            if word and list(fresh[word]) != theirs:  # the lone mark of a text that ends in a space is no text of its own
                self.differing.add(word)
        self.recent.update((word, ids) for word, ids in fresh.items() if len(word) <= SHORT)
        return fresh

    def encode_all(self, texts: list[str]) -> list[list[int]]:
        if len(self.recent) >= REMEMBERED:
            self.older, self.recent = self.recent, {}
        split = [self.words(text) for text in texts]
        unseen = {word for words in split for word in words if word not in self.recent}
        fresh = self.remember(list(unseen)) if unseen else {}
        out = []
        for words in split:
            found = list(map(self.recent.get, words))
            if None in found:
                found = [fresh[w] if ids is None else ids for w, ids in zip(words, found, strict=True)]
            out.append(list(chain.from_iterable(found)))
        return out

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0]

    def differs(self, text: str) -> bool:
        """Whether the library gives other ids for some word of the text."""
        return bool(self.differing) and not self.differing.isdisjoint(self.words(text))

    def decode(self, ids: list[int]) -> str:
        parts = list(map(self.surface.__getitem__, ids))
        if None not in parts:
            text = "".join(parts)
            return text[1:] if text.startswith(" ") else text
        out, raw, begun = [], bytearray(), False
        for i, part in zip(ids, parts, strict=True):
            if i in self.byte_of:
                raw.append(self.byte_of[i])
                begun = True
                continue
            if raw:
                out.append(raw.decode("utf-8", "arborframe.each_byte"))
                raw.clear()
            if part is None:
                out.append(UNKNOWN if i == self.unknown else "")
                begun = begun or i == self.unknown
            else:
                out.append(part[1:] if not begun and part.startswith(" ") else part)
                begun = True
        out.append(raw.decode("utf-8", "arborframe.each_byte"))
        return "".join(out)


def held_pieces(model: str) -> Pieces:
    """The worker process's vocabulary with its recent words, kept on the library's module: each task gets its own copy of this one."""
    held = sentencepiece.__dict__.setdefault("_arborframe_pieces", {})
    if model not in held:
        held[model] = Pieces(model)
    return held[model]


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list]]:
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            rows = list(rows_of(batch.slice(at, SLICE)))
            yield [r[0] for r in rows], [r[1] for r in rows]


def encoded(docs: DataFrame, model: str | None = None) -> DataFrame:
    """(doc_id, ids): the ids of every whole text."""
    model = model or default_model()
    types = [("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = held_pieces(model)
        for keys, texts in slices(batches):
            yield table_of(list(zip(keys, vocabulary.encode_all(texts), strict=True)), types)

    return texts_of(docs).mapInArrow(run, "doc_id long, ids array<int>")


def decoded(tokens: DataFrame, model: str | None = None) -> DataFrame:
    """(doc_id, text) of tokens(doc_id, ids)."""
    model = model or default_model()
    types = [("doc_id", pa.int64()), ("text", pa.string())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = held_pieces(model)
        for keys, ids in slices(batches):
            yield table_of([(k, vocabulary.decode(i)) for k, i in zip(keys, ids, strict=True)], types)

    rows = tokens.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))
    return rows.mapInArrow(run, "doc_id long, text string")


def texts_of(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def round_trip(docs: DataFrame, model: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, agrees): encoded and decoded again, checked against the library."""
    model = model or default_model()
    types = [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string()), ("agrees", pa.bool_())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = held_pieces(model)
        digits = vocabulary.digits
        for keys, texts in slices(batches):
            ids = vocabulary.encode_all(texts)
            back = vocabulary.library.decode(ids, num_threads=1)
            out = []
            for key, text, own, theirs in zip(keys, texts, ids, back, strict=True):
                again = vocabulary.decode(own)
                agrees = again == theirs and not vocabulary.differs(text)
                out.append((key, len(own), sha256(",".join(map(digits.__getitem__, own))), sha256(again), agrees))
            yield table_of(out, types)

    return texts_of(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, agrees boolean")
