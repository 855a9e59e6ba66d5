"""Several values packed in one field: split them into one row per value, position kept.

The delimiters of a field are resolved per *skeleton*, the field with all ordinary characters
masked. Few distinct skeletons stand for many rows, so the (procedural) resolution runs once
per skeleton; its result, a split mask, is joined back and applied by position with built-in
array functions. Values never leave the JVM."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeloom.session import small_side, stage

# ---------------------------------------------------------------- author lists

#: Words that name organisations (fixed values).
ORG_WORDS = (
    "university", "univ", "institute", "inst", "laboratory", "lab", "laboratories", "society", "soc", "centre", "center",
    "ctr", "consortium", "cons", "department", "dept", "group", "association", "assoc", "academy", "acad", "college",
    "coll", "council", "agency", "committee", "foundation", "school", "team", "project",
)

_SEP_CH = r";|/•·&,¶"
_ITEM_DELIM = (
    rf"(?:\s*[{_SEP_CH}]|\s*[\t\r\n]|(?<=[\s{_SEP_CH}])and(?=\s))"
    rf"(?:\s*(?:[{_SEP_CH}]|and(?=\s)))*\s*"
)
_ITEM_TOKENS = rf'(?U)("[^"]*"|{_ITEM_DELIM}|(?:(?!{_ITEM_DELIM})[^"])+|")'
_ET_AL = r"(?iU)[\s,;|/•·&]*(?:\band\s+)?\bet\.?\s+al\b\.?[\s,;|/•·&]*$"
_PARTICLES = r"(?:(?:\p{Ll}[\p{L}'’.-]*|VAN|VON|DE|DER|DEN|DI|DU|DA|LA|LE|TEN|TER)\s+)*"
_ORG = r"(?iU)\b(?:" + "|".join(ORG_WORDS) + r")\b"


def _item_code(t: Column) -> Column:
    """One letter for what a token of an author list is."""
    d = F.regexp_replace(t, r"(?U)\s+", " ")
    return (
        F.when(t.startswith('"'), F.when(F.length(t) > 1, "Q").otherwise("e"))
        .when(t.rlike(rf"^(?:{_ITEM_DELIM})$".replace("(?<=", "(?:^|").replace("(?U)", "")) | t.rlike(r"^\s*and\s+$"),
              F.when(F.trim(d) == ",", "c").when(F.trim(d) == "and", "a").otherwise("s"))
        .when(F.trim(d) == "", "e")
        .when(d.rlike(r"(?i)^\s*(?:jr|sr|ii|iii|iv)\.?\s*$"), "J")
        .when(d.rlike(r"^\s*(?:\p{Lu}[\p{M}]*\.?[\s-]?){1,4}\s*$"), "i")
        .when(d.rlike(rf"(?iU)^\s*(?!univ)(?:{'|'.join(ORG_WORDS)})\b\.?\s(?:for|of)\s+\S+\s*$"), "O")
        .when(d.rlike(r"(?iU)\b(?:for|of)\s+\S+\s*$"), "o")
        .when(d.rlike(_ORG), "f")
        .when(d.rlike(rf"^\s*{_PARTICLES}\S+\s*$"), "w")
        .when(d.rlike(r"^\s*\S+(?:\s+\p{Lu}\.)+\s*$"), "g")
        .otherwise("f")
    )


def resolve_author_skeleton(s: str) -> str:
    """The split mask of one author skeleton: S starts a value, J joins on, X is dropped.

    ``c`` comma, ``a`` the word "and", ``s`` any other delimiter, ``w`` one word, ``g`` a given
    name with initials, ``i`` initials, ``o`` ends in "for/of X", ``O`` nothing but
    "Institute of X" (its name is still to come), ``J`` name suffix, ``Q``
    quoted, ``e`` blank, ``f`` anything else."""
    out = ["X"] * len(s)
    pieces = [k for k, ch in enumerate(s) if ch not in "case"]
    # only commas between single words: Surname, Given pairs if their number is even
    words_only = all(s[k] == "w" for k in pieces) and all(ch in "cwe" for ch in s)
    pair_words = not words_only or len(pieces) % 2 == 0
    k, n = 0, len(s)
    prev, done = -1, True  # the last piece; whether its value may not be continued
    while k < n:
        ch = s[k]
        if ch in "case":
            k += 1
            continue
        gap = s[prev + 1 : k] if prev >= 0 else ""
        after_is_delim = k + 1 >= n or s[k + 1] in "case"
        if prev >= 0 and gap == "c" and ch == "J":
            join, done_next = True, True
        elif prev >= 0 and not done and gap == "c" and s[prev] == "w" and (ch in "gi" or ch == "w" and pair_words):
            join, done_next = True, True
        elif prev >= 0 and gap == "a" and s[prev] == "o" and ch == "w" and after_is_delim and (k + 1 >= n or s[k + 1] != "c" or k + 2 >= n or s[k + 2] not in "gi"):
            join, done_next = True, True
        elif prev >= 0 and gap == "a" and s[prev] == "O" and ch in "wf":
            join, done_next = True, True
        elif prev >= 0 and gap == "":
            join, done_next = True, done
        else:
            join, done_next = False, False
        if join:
            out[prev + 1 : k + 1] = "J" * (k - prev)
        else:
            out[k] = "S"
        prev, done = k, done_next
        k += 1
    return "".join(out)


# ---------------------------------------------------------------- citations

_CF = r"[\p{Cf}\x{200B}]*"
_YEAR = rf"(?<![\p{{Nd}}\p{{L}}.–/-])(?:[1１]{_CF}[9９]|[2２]{_CF}[0０]){_CF}\p{{Nd}}{_CF}\p{{Nd}}(?![\p{{Nd}}–-])"
_ID = r"(?i:https?:\s*//\S+|\b10\.\d{4,9}/\S+|\barxiv\s*:\s*\S+|\b\d{4}\.\d{4,5}(?:v\d+)?)"
_NAME_AFTER = (
    r"(?=\s*(?:and\s)?\s*(?:"
    r"(?:\p{Lu}\p{M}*\.[\s-]?){1,3}(?:\p{Ll}[\p{L}'’-]*\s)*\p{Cf}*\p{Lu}[\p{L}\p{M}\p{Cf}'’-]+\s*(?:,|\.|\(|&|\band\b|\bet\b|;)"
    r"|\p{Lu}[\p{L}\p{M}\p{Cf}'’-]+(?:\s\p{Lu}\.?)*\s(?:\p{Ll}[\p{L}'’-]*\s)*\p{Cf}*\p{Lu}[\p{L}\p{M}\p{Cf}'’-]+\s*(?:,|\.\s|\(|&|\band\b|\bet\b|;)"
    r"|(?:\p{Ll}[\p{L}'’-]*\s)*\p{Lu}[\p{L}\p{M}\p{Cf}'’-]+\s?,\s\p{Lu}"
    r"|[^.,“”\"\n]{0,80}\b(?i:" + "|".join(ORG_WORDS) + r")\b"
    r"))"
)
_END_BEFORE = r"(?<=\p{Nd}[\p{Cf}\x{200B}]{0,3}|\p{Nd}[\p{Cf}\x{200B}]{0,3}[.\"”)]|\p{Nd}[\p{Cf}\x{200B}]{0,3}\.[\"”)])"
_MARK = rf"(?:\[\p{{Nd}}{{1,4}}\]|(?:(?<=^)|{_END_BEFORE}(?<=[\s.\p{{Nd}}]))\s*\(\p{{Nd}}{{1,3}}\)(?=\s))"
#: Tokens of a raw citation field, by kind; each names one letter of the skeleton.
_RAW_KINDS = (
    ("M", rf"\s*{_MARK}\s*"),
    ("Q", r"\"\s*[,;|]?\s*\""),
    ("P", rf"{_END_BEFORE}\s*(?:[|•·¶]|//)+\s*"),
    ("h", rf"{_END_BEFORE}\s*(?:;|[\r\n]+)\s*{_NAME_AFTER}"),
    ("x", rf"{_END_BEFORE}\s*(?:;|[\r\n]+)\s*"),
    ("I", _ID),
    ("Y", _YEAR),
)
_RAW_ANY = "|".join(p for _, p in _RAW_KINDS)
_RAW_TOKENS = rf"(?sU)({_RAW_ANY}|(?:(?!{_RAW_ANY}).)+)"


def resolve_citation_skeleton(s: str) -> str:
    """The split mask of one citation skeleton (see ``_RAW_KINDS``; ``t`` is any other text).

    Numbered markers, quote pairs and typographic bars always split. A line break or semicolon
    splits only between two years: at the last one that a name follows, else at the last one."""
    cuts: set[int] = {k for k, ch in enumerate(s) if ch in "MQP"}
    years = [k for k, ch in enumerate(s) if ch == "Y"]
    for y, z in zip(years, years[1:]):
        if any(y < c < z for c in cuts):
            continue
        weak = [k for k in range(y + 1, z) if s[k] in "hx"]
        if named := [k for k in weak if s[k] == "h"]:
            cuts.add(named[-1])
        elif weak:
            cuts.add(weak[-1])
    out, fresh = [], True
    for k, ch in enumerate(s):
        if k in cuts:
            out.append("X")
            fresh = True
        else:
            out.append("S" if fresh else "J")
            fresh = False
    return "".join(out)


# ---------------------------------------------------------------- the operator


def _resolver(resolve: Callable[[str], str]) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.assign(mask=[resolve(s) for s in b["skeleton"]])

    return run


def _raw_code(t: Column) -> Column:
    """One letter for what a token of a citation field is. ``h`` and ``x`` are told apart while
    tokenising: a ``h`` token carries a trailing mark (see ``_tokens``)."""
    return (
        F.when(t.rlike(rf"^(?U)\s*{_MARK}\s*$"), "M")
        .when(t.rlike(r"(?U)^\"\s*[,;|]?\s*\"$"), "Q")
        .when(t.rlike(r"(?U)^\s*(?:[|•·¶]|//)+\s*$"), "P")
        .when(t.rlike(r"(?U)^\s*(?:;|[\r\n]+)\s*\x01$"), "h")
        .when(t.rlike(r"(?U)^\s*(?:;|[\r\n]+)\s*$"), "x")
        .when(t.rlike(rf"^{_ID}$"), "I")
        .when(t.rlike(rf"^(?:[1１]{_CF}[9９]|[2２]{_CF}[0０]){_CF}\p{{Nd}}{_CF}\p{{Nd}}$"), "Y")
        .otherwise("t")
    )


def split_packed(df: DataFrame, key: str, field: str, kind: str) -> DataFrame:
    """(key, pos, n_items, item) for every value packed in ``field``.

    ``kind`` is ``authors`` (names, "et al." is no value) or ``citations`` (whole citations, the
    running number is dropped). Items are spelt as in the field without surrounding blanks,
    delimiters or enclosing quotes; ``pos`` counts from 0. NULL and blank fields give no row; a
    field with one value gives one row at pos 0; repeated rows each give their own rows; other
    columns of ``df``, of whatever name, are ignored."""
    src = df.select(F.col(key).alias("k"), F.col(field).alias("v")).where(F.col("v").isNotNull())
    if kind == "authors":
        body = F.regexp_replace(F.col("v"), _ET_AL, "")
        tok = src.select("k", F.regexp_extract_all(body, F.lit(_ITEM_TOKENS), F.lit(1)).alias("tok"))
        tok = tok.withColumn("skeleton", F.array_join(F.transform("tok", _item_code), ""))
        rest = None
        resolve = resolve_author_skeleton
    elif kind == "citations":
        bare = F.regexp_replace(F.col("v"), rf"(?U){_ID}", "#")
        several = (F.regexp_count(bare, F.lit(rf"(?U){_YEAR}")) > 1) | (F.regexp_count(F.col("v"), F.lit(_MARK)) > 1)
        rest = src.where(~several)
        src = src.where(several)
        # strip quotes that enclose the whole field; mark separators that a name follows
        body = F.regexp_replace(F.col("v"), r"(?sU)^\s*\"(.*)\"\s*$", "$1")
        body = F.regexp_replace(body, rf"(?U)({_END_BEFORE}\s*(?:;|[\r\n]+)\s*){_NAME_AFTER}", "$1\u0001")
        tokens = _RAW_TOKENS.replace(_NAME_AFTER, "\u0001")
        tok = src.select("k", F.regexp_extract_all(body, F.lit(tokens), F.lit(1)).alias("tok"))
        tok = tok.withColumn("skeleton", F.array_join(F.transform("tok", _raw_code), ""))
        resolve = resolve_citation_skeleton
    else:
        raise ValueError(f"unknown kind {kind!r}")
    tok = stage(tok, "packed")
    rules = stage(
        tok.select("skeleton").distinct().mapInPandas(_resolver(resolve), "skeleton string, mask string"), "rules"
    )
    marked = F.zip_with(
        "tok", F.split("mask", ""),
        lambda t, m: F.when(m == "S", F.concat(F.lit("\u0002"), t)).when(m == "J", t).otherwise(""),
    )
    items = F.transform(
        F.split(F.array_join(marked, ""), "\u0002"),
        lambda x: F.regexp_replace(
            F.regexp_replace(F.regexp_replace(x, "\u0001", ""), r"(?U)^[\s;|•·¶&]+|[\s;|•·¶&,]+$", ""), r"(?sU)^\"\s*(.*?)\s*\"$", "$1"
        ),
    )
    out = tok.join(small_side(rules), "skeleton").select("k", F.filter(items, lambda x: x != "").alias("items"))
    if rest is not None:
        one = F.regexp_replace(F.col("v"), rf"(?U)^\s*(?:{_MARK})?\s*|\s+$", "")
        one = F.regexp_replace(one, r"(?sU)^\"([^\"]*)\"$", "$1")
        out = out.unionByName(rest.select("k", F.array(one).alias("items")).where(F.col("items")[0] != ""))
    return out.select(F.col("k").alias(key), F.size("items").alias("n_items"), F.posexplode("items").alias("pos", "item"))
