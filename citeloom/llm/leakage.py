"""Problem 8: evaluation texts leaking into training text.

One Aho-Corasick automaton over the normalised items scans every document once. Its patterns
are the items' word sequences of SEED words at every SEED-th word: any ``min_words`` = 2 * SEED - 1
consecutive words of an item hold one of them whole, so no leak is missed and the automaton is
as large as the items, not as all their windows. Every match is extended to both sides word by
word, and mapped back to the original text by word number.

The items are broadcast in blocks of at most ``MAX_BLOCK_CHARS`` characters. The documents are read once
however many blocks there are: a task buffers some texts and passes them through one automaton
after the other. A worker keeps its last automaton, so a single block is built once per worker."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters of item text in one automaton (its nodes cost some 50 bytes a character).
MAX_BLOCK_CHARS = 2_000_000
#: Characters of documents a task buffers while it changes automata.
BUFFER_CHARS = 16_000_000

_NON_WORD = re.compile(r"[\W_]+")
_WORD = re.compile(r"[^\W_]+")

OUT = "doc_id long, item_id long, words int, first_char long, last_char long"
Items = list[tuple[int, str]]


def normalise(text: str) -> str:
    """Words in lower case, one blank before and after each."""
    return f" {_NON_WORD.sub(' ', text).lower().strip()} "


class Matcher:
    """The automaton of a block of items with the items' words to extend matches by."""

    def __init__(self, items: Items, min_words: int) -> None:
        self.min_words, self.words = min_words, {}
        size = (min_words + 1) // 2
        seeds: dict[str, list[tuple[int, int]]] = {}
        for k, (item, text) in enumerate(items):
            w = normalise(text).split()
            if len(w) < min_words:
                continue
            self.words[k] = (item, w)
            for i in range(0, len(w) - size + 1, size):
                seeds.setdefault(" " + " ".join(w[i : i + size]) + " ", []).append((k, i))
        self.automaton = ahocorasick.Automaton()
        for s, places in seeds.items():
            self.automaton.add_word(s, (len(s), tuple(places)))
        if seeds:
            self.automaton.make_automaton()

    def scan(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item, words, first char, last char) for every maximal run of item words in ``text``."""
        if not self.words:
            return []
        norm = normalise(text)
        hits = [(end - length + 1, places) for end, (length, places) in self.automaton.iter(norm)]
        if not hits:
            return []
        words, word_at, at = norm.split(), {}, 0
        for n, w in enumerate(words):  # number of the word that follows the blank at a place
            word_at[at] = n
            at += len(w) + 1
        runs: dict[int, set[tuple[int, int]]] = {}
        seen: set[tuple[int, int, int]] = set()
        for start, places in hits:
            d = word_at[start]
            for k, i in places:
                # a run already found covers every later seed on the same alignment
                if (k, d - i, i) in seen:
                    continue
                item, own = self.words[k]
                a, b = 0, 0
                while a < min(d, i) and words[d - a - 1] == own[i - a - 1]:
                    a += 1
                while d + b < len(words) and i + b < len(own) and words[d + b] == own[i + b]:
                    b += 1
                seen.update((k, d - i, x) for x in range(i - a, i + b))
                if a + b >= self.min_words:
                    runs.setdefault(item, set()).add((d - a, d + b))
        if not runs:
            return []
        spans = [m.span() for m in _WORD.finditer(text)]
        out = []
        for item, found in sorted(runs.items()):
            merged: list[list[int]] = []
            for a, b in sorted(found):
                if merged and a <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], b)
                else:
                    merged.append([a, b])
            out += [(item, b - a, spans[a][0], spans[b - 1][1]) for a, b in merged]
        return out


_last: list = [None, None]  # the automaton this worker built last, and what for


def _matcher(name: str, block: Broadcast, min_words: int) -> Matcher:
    if _last[0] != (name, min_words):
        _last[:] = [None, None]  # the old one goes before the new one is built
        _last[:] = [(name, min_words), Matcher(block.value, min_words)]
    return _last[1]


def _scanner(blocks: dict[str, Broadcast], min_words: int):
    def flush(held: list[tuple[int, str]]) -> Iterator[pa.RecordBatch]:
        for name, block in blocks.items():
            m = _matcher(name, block, min_words)
            rows = [(doc, *hit) for doc, text in held for hit in m.scan(text)]
            if rows:
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["doc_id", "item_id", "words", "first_char", "last_char"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, str]] = []
        chars = 0
        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                held.append((doc, text))
                chars += len(text)
                if chars > BUFFER_CHARS:
                    yield from flush(held)
                    held, chars = [], 0
            if len(blocks) == 1:  # nothing to change: the texts go through at once
                yield from flush(held)
                held, chars = [], 0
        yield from flush(held)

    return run


def item_blocks(what: DataFrame) -> dict[str, Broadcast]:
    """The items (i, t) in named broadcasts of about ``MAX_BLOCK_CHARS`` characters, collected block by
    block."""
    sc, out = what.sparkSession.sparkContext, {}

    def send(block: Items) -> None:
        out[uuid.uuid4().hex] = sc.broadcast(block)

    block, chars = [], 0
    for r in what.toLocalIterator():
        block.append((r["i"], r["t"]))
        chars += len(r["t"])
        if chars >= MAX_BLOCK_CHARS:
            send(block)
            block, chars = [], 0
    if block:
        send(block)
    return out


def find_leaks(docs: DataFrame, items: DataFrame, min_words: int = 13, doc_id: str = "doc_id", text: str = "text",
               item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, item_id, words, first_char, last_char): every maximal run of at least
    ``min_words`` consecutive words of an item in a document; the characters are offsets of the
    run in the original text.

    What stands between the words in the way of blanks, line breaks and punctuation is ignored,
    as is letter case. Runs that touch or overlap are one. Items shorter than ``min_words`` words
    cannot leak. NULL texts and ids give no row, repeated documents a row each, tables without
    rows an empty result; other columns are ignored whatever their names."""
    src = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).where("doc_id is not null and text is not null")
    what = items.select(F.col(item_id).cast("long").alias("i"), F.col(item_text).alias("t")).where("i is not null and t is not null")
    return src.mapInArrow(_scanner(item_blocks(what), min_words), OUT)
