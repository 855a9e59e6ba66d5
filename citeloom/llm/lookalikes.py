"""Problem 2: visually identical text with different characters.

Text is brought to one form in three steps: compatibility normalisation, deletion of ignorable
characters, and, for tokens that mix scripts, a search for the most probable reading. Every
letter of such a token stands for itself or one of its look-alikes; Viterbi finds the best path
through that lattice under bigram scores learnt, per script, from all tokens of the corpus that
are written in one script."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from math import log

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: Letters of other scripts that look like Latin ones (fixed values).
LOOK_ALIKES = """
Cyrillic lower: а a е e о o р p с c у y х x ѕ s і i ј j һ h ԁ d ԛ q ԝ w к k
Cyrillic upper: А A В B Е E К K М M Н H О O Р P С C Т T У Y Х X Ѕ S І I Ј J Ү Y Ԛ Q Ԝ W
Greek lower: α a ο o ν v υ u ρ p ι i κ k
Greek upper: Α A Β B Ε E Ζ Z Η H Ι I Κ K Μ M Ν N Ο O Ρ P Τ T Υ Y Χ X
"""
SWITCH, REPLACE, SMOOTH = -14.0, -2.0, 0.1

#: Nothing to do for a text without any character outside these: ASCII, single accented letters
#: and typographic punctuation. None of them is changed by compatibility normalisation.
_PLAIN = r"^[\x00-\x7F¡-§©«¬®°±¶·»¿-ıĴ-ľŁ-ňŊ-žƀ-ǃǍ-ǰǴ-ɏ‐‒-‖‘-‣‰-′‵‸-›]*$"
_IGNORABLE = re.compile("[­͏؜ᅟᅠ឴឵᠋-᠎​-‏‪-‮⁠-⁯ㅤ︀-️﻿ﾠ\U000e0000-\U000e0fff]")
_TOKEN = re.compile(r"[^\W\d_]+")
_ACCENT = re.compile("[̀-ͯ]")

_TO_LATIN: dict[str, str] = {}
for _line in LOOK_ALIKES.strip().splitlines():
    _letters = _line.partition(":")[2].split()
    _TO_LATIN.update(zip(_letters[::2], _letters[1::2]))
_ALIKE: dict[str, list[str]] = {}
for _x, _y in _TO_LATIN.items():
    _group = [_y, *[k for k, v in _TO_LATIN.items() if v == _y]]
    for _c in _group:
        _ALIKE[_c] = [c for c in _group if c != _c]


@lru_cache(maxsize=65536)
def script(ch: str) -> str:
    """L, C, G or ? for Latin, Cyrillic, Greek and other letters."""
    if ch.isascii() or ch == "ſ":
        return "L"
    name = unicodedata.name(ch, "")
    return {"LATIN": "L", "CYRILLIC": "C", "GREEK": "G"}.get(name.partition(" ")[0], "?")


def _scripts(token: str) -> str:
    return "".join(sorted({script(c) for c in token}))


class Model:
    """Bigram scores by script. ``^`` and ``$`` stand for the ends of a token."""

    def __init__(self, counts: dict[tuple[str, str, str], int]) -> None:
        self.counts, self.totals, self.letters = counts, {}, {}
        for (s, a, b), n in counts.items():
            self.totals[s, a] = self.totals.get((s, a), 0) + n
            self.letters.setdefault(s, set()).add(b)

    def step(self, s: str, a: str, b: str) -> float:
        size = max(30, len(self.letters.get(s, ())))
        return log((self.counts.get((s, a, b), 0) + SMOOTH) / (self.totals.get((s, a), 0) + SMOOTH * size))

    def reading(self, token: str) -> str:
        """The most probable way to write ``token`` with look-alike letters."""
        layer: list[tuple[float, str, str]] | None = None  # best score, last letter, path
        for ch in token:
            here = []
            for cand in (ch, *_ALIKE.get(ch, ())):
                s, low = script(cand), cand.lower()
                cost = 0.0 if cand == ch else REPLACE
                if layer is None:
                    here.append((cost + self.step(s, "^", low), cand, cand))
                else:
                    score, path = max(
                        (v + (self.step(s, p.lower(), low) if script(p) == s else SWITCH), path) for v, p, path in layer
                    )
                    here.append((score + cost, cand, path + cand))
            layer = here
        return max((v + self.step(script(p), p.lower(), "$"), path) for v, p, path in layer or [(0.0, "", "")])[1]


def _compat(ch: str) -> bool:
    """A wide or joined form of ordinary letters or digits?"""
    kind = unicodedata.decomposition(ch).partition(" ")[0]
    return kind in ("<wide>", "<narrow>", "<compat>", "<font>") and unicodedata.normalize("NFKC", ch).isalnum() and ch != "µ"


def plain_form(text: str) -> tuple[str, bool]:
    """``text`` in compatibility form without ignorable characters, and whether it had any
    character that should not be there."""
    odd = bool(_IGNORABLE.search(text))
    s = _IGNORABLE.sub("", text)
    if not odd:
        odd = any(ord(c) > 127 and (unicodedata.category(c) in ("Zs", "Zl", "Zp") or _compat(c)) for c in set(s))
    if not odd and _ACCENT.search(s):
        odd = unicodedata.normalize("NFC", s) != s and any(
            len(unicodedata.normalize("NFC", m)) == 1 for m in re.findall("[^̀-ͯ][̀-ͯ]", s)
        )
    return unicodedata.normalize("NFKC", s).replace(" ", "\n").replace(" ", "\n"), odd


def consistent(text: str, model: Model) -> tuple[str, bool]:
    """The consistent form of ``text`` and whether it held a character to be replaced."""
    s, odd = plain_form(text)
    out, at = [], 0
    tokens = list(_TOKEN.finditer(s))
    kinds = [_scripts(m.group()) for m in tokens]
    for k, m in enumerate(tokens):
        t, new = m.group(), None
        if len(kinds[k]) > 1:
            new = model.reading(t)
        elif kinds[k] in ("C", "G") and len(t) == 1 and t in _ALIKE:
            near = [kinds[i] for i in (k - 1, k + 1) if 0 <= i < len(kinds)]
            initial = s[m.end() : m.end() + 1] == "."
            # an initial before a Latin name; a Cyrillic letter as a word between Latin words
            if initial and (near[-1:] == ["L"] or near[:1] == ["L"]) or kinds[k] == "C" and near and all(x == "L" for x in near) and s[m.end() : m.end() + 1] != "-":
                new = _TO_LATIN.get(t)
        if new is not None and new != t:
            odd = True
            out += [s[at : m.start()], new]
            at = m.end()
    return "".join(out) + s[at:], odd


def train(texts: DataFrame, text: str = "text") -> Model:
    """Bigram counts over all tokens of all ``texts`` that are written in one script. The table is
    bounded by the squares of the alphabets, not by the data."""

    def bigrams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows: dict[tuple[str, str, str], int] = {}
            for t, n in zip(b["token"], b["n"]):
                s = _scripts(t)
                if s in ("L", "C", "G"):
                    for pair in zip("^" + t, t + "$"):
                        rows[(s, *pair)] = rows.get((s, *pair), 0) + n
            yield pd.DataFrame([(*k, n) for k, n in rows.items()], columns=["s", "a", "b", "n"])

    words = texts.select(F.explode(F.regexp_extract_all(F.lower(F.col(text)), F.lit(r"(\p{L}+)"), F.lit(1))).alias("token"))
    counts = words.groupBy("token").agg(F.count(F.lit(1)).alias("n")).mapInPandas(bigrams, "s string, a string, b string, n long")
    total = counts.groupBy("s", "a", "b").agg(F.sum("n").alias("n"))
    return Model({(r["s"], r["a"], r["b"]): r["n"] for r in total.toLocalIterator()})


def consistent_texts(rows: DataFrame, scope: str, key: str, text: str) -> DataFrame:
    """(scope, key, form, changed): the consistent form of every text and whether it held an
    invisible character, an unusual space, a wide or joined form, a separate accent or a letter
    of another script in a word or initial it does not belong to.

    Words wholly in another script, Greek letters as symbols, and typographic punctuation are
    left alone. NULL texts give no row, empty ones themselves; repeated rows a row each; other
    columns are ignored. Texts of plain characters never leave the JVM."""
    src = rows.select(F.col(scope).alias("scope"), F.col(key).alias("key"), F.col(text).alias("text")).where("text is not null")
    model = train(src)
    sent = src.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            done = [consistent(t, sent.value) for t in b["text"]]
            yield pd.DataFrame({"scope": b["scope"], "key": b["key"], "form": [x for x, _ in done], "changed": [y for _, y in done]})

    plain = F.col("text").rlike(_PLAIN)
    kinds = dict(src.dtypes)
    odd = src.where(~plain).mapInPandas(run, f"scope {kinds['scope']}, key {kinds['key']}, form string, changed boolean")
    return odd.unionByName(src.where(plain).select("scope", "key", F.col("text").alias("form"), F.lit(False).alias("changed")))
