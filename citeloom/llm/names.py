"""Problem 3: variant spellings of names typed by people.

Every distinct spelling is parsed into words and initials. Spellings are blocked by the phonetic
codes of their sorted words, compared word by word with Jaro-Winkler, one-edit typing errors and
a nickname table, and clustered by connected components.

Full names are blocked by the codes of two words, spellings with initials by the code of the
surname and an initial. Since a typing error may change a code, one word of a block enters with
the codes of all its forms less one letter as well: words one edit apart have such a form in
common, and nicknames enter with the code of the full name. So any two spellings that
``same_name`` accepts share a block, however frequent their words are."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeloom.operators.components import connected_components
from citeloom.operators.skew import within_blocks
from citeloom.session import stage

#: Given names and their short forms (fixed values).
NICKNAMES = """
Abigail: Abby | Agnes: Aggie | Albert: Al Bert Bertie | Alexander: Alex Sandy | Alice: Allie | Amelia: Amy Millie Mia
Andrew: Andy Drew | Anthony: Tony Ant | Arthur: Art Artie | Barbara: Babs Barb Barbie | Benjamin: Ben Benny Benji
Bernard: Bernie | Bridget: Biddy Bridie Bridge | Catherine: Cathy | Charles: Charlie Chuck Chas | Christopher: Chris Kit Topher
Conrad: Con Connie | Cynthia: Cindy | Daniel: Dan Danny | David: Dave Davey | Deborah: Deb Debbie Debra | Dorothy: Dot Dottie Dolly
Edward: Ed Eddie Ned Ted Teddy | Eleanor: Ellie Nell Nora | Elizabeth: Liz Beth Betty Eliza Lizzie Libby Bess
Eugene: Gene | Florence: Flo Florrie | Frances: Fran Fanny | Francis: Frank | Frederick: Fred Freddie Freddy | Gabriel: Gabe
Georgina: Georgie Gina | Gerald: Gerry Jerry | Gideon: Gid | Gregory: Greg | Hannah: Anna Nan | Harold: Harry Hal | Helena: Nell Lena Ellen
Henry: Hank | Horatio: Horace Ray | Isaac: Ike Zac | Isidora: Isa Izzy Dora | Jacob: Jake | James: Jim Jimmy Jamie Jem | Jasper: Jas
Jennifer: Jen Jenny Jennie | John: Jack Johnny | Joseph: Joe Joey Jo | Josephine: Jo Josie Josey | Judith: Judy Jude
Katherine: Kate Kathy Katie Kay Kitty Kat | Kenneth: Ken Kenny | Konstantin: Kostya Kon | Laurence: Larry Laurie Lars
Leonard: Len Lenny Leo | Leopold: Leo Poldi | Lucinda: Lucy Cindy Lulu | Magdalena: Magda Lena Maggie | Margaret: Maggie Meg Peggy Greta Madge Marge
Matthew: Matt Matty | Maximilian: Max | Michael: Mike Mick Mickey Mikey | Miranda: Mira Randy Mandy | Nathaniel: Nat Nate Nathan
Nicholas: Nick Nicky Nico | Noemi: Naomi Mimi | Octavia: Tavia Tavy | Oliver: Ollie Noll | Oswald: Oz Ozzie | Patricia: Pat Patty Tricia Trish Patsy
Patrick: Paddy Pat | Penelope: Penny Nell | Percival: Percy | Peter: Pete | Philip: Phil | Philippa: Pip Pippa | Quentin: Quinn
Rebecca: Becky Becca Bec | Reginald: Reg Reggie Rex | Richard: Dick Rich Rick Ricky Richie | Robert: Bob Bobby Rob Robbie Bert
Ronald: Ron Ronnie | Rosalind: Ros Roz Rosie Linda | Rupert: Rupe Bert | Samuel: Sam Sammy | Sebastian: Seb Bas Bastian | Sidonia: Sid Sidonie
Solomon: Sol Solly | Stephen: Steve Stevie Steph | Susannah: Sue Susie Suzy Anna | Theodore: Ted Teddy Theo | Thomas: Tom Tommy
Timothy: Tim Timmy | Ursula: Ursa Ulla | Valentina: Val Tina | Victoria: Vicky Vickie Vic Tori | Vincent: Vince Vin Vinny | Walter: Walt Wally Wat
Wilhelmina: Mina Willa Billie Minnie | William: Will Bill Billy Willy Liam | Winifred: Win Winnie Freda | Xenia: Xen | Yolanda: Yola Lana
Zachary: Zach Zack Zac | Zelda: Zel
"""
#: Words of organisation names and their abbreviations (fixed values).
ABBREVIATIONS = """
academy: acad | agency: agcy | association: assoc assn | centre: ctr cent center cntr | college: coll | committee: comm cttee | consortium: cons
council: coun | department: dept dep | engineering: eng engng | foundation: found fdn fndn | group: grp | institute: inst | international: intl int
laboratory: lab labs | machine: mach | measurement: meas measmt | mathematics: math maths | national: natl nat | optics: opt | acoustics: acoust acous
records: rec recs | research: res rsch | school: sch | science: sci | society: soc | statistics: stat stats | technology: tech technol
translation: transl trans | university: univ uni | data: dat
"""
SMALL_WORDS = {"the", "of", "for", "and", "de", "van", "von", "der", "den", "di", "du", "da", "la", "le", "ten", "ter", "et", "jr", "sr", "ii", "iii", "iv"}
MIN_SIMILARITY = 0.85


def _lists(text: str) -> dict[str, list[str]]:
    out = {}
    for entry in re.split(r"[|\n]", text.lower()):
        if entry.strip():
            full, _, short = entry.partition(":")
            out[full.strip()] = short.split()
    return out


_NICK: dict[str, set[str]] = {}
for _full, _short in _lists(NICKNAMES).items():
    for _s in _short:
        _NICK.setdefault(_s, set()).add(_full)
_ABBR = {s: full for full, short in _lists(ABBREVIATIONS).items() for s in short}
_ORG = set(_lists(ABBREVIATIONS)) - {"data", "machine", "optics", "records", "measurement"}


def fold(s: str) -> str:
    """Lower case without accents."""
    return "".join(c for c in unicodedata.normalize("NFKD", s).casefold() if not unicodedata.combining(c))


def parse_name(name: str) -> tuple[bool, list[str], list[str]]:
    """(is an organisation, words, initials) of a spelling. Words are folded and in the order
    written, surname first where a comma shows it; small words and suffixes are left out."""
    tokens = re.findall(r"[^\W\d_]+(?:['’-][^\W\d_]+)*\.?|\d+", name)
    full = [_ABBR.get(fold(t.rstrip(".")), "") for t in tokens]
    if any(f in _ORG or fold(t) in _ORG for f, t in zip(full, tokens)):
        return True, [f or fold(t.rstrip(".")) for f, t in zip(full, tokens) if fold(t.rstrip(".")) not in SMALL_WORDS], []
    words, initials = [], []
    for t in tokens:
        bare = t.rstrip(".")
        if len(bare) == 1:
            initials.append(fold(bare))
        elif fold(bare) in SMALL_WORDS and not (bare.isupper() and len(tokens) == 2):  # "Surname JR"
            continue
        elif bare.isupper() and len(bare) <= 3 and len(tokens) > 1 and not re.search(r"[^\W\d_]{4,}\s*,", bare):
            initials += list(fold(bare))  # "Surname HT"
        else:
            words.append(fold(bare))
    if not words and initials:  # nothing but capitals: a short surname
        words, initials = ["".join(initials)], []
    return False, words, initials


def jaro_winkler(a: str, b: str) -> float:
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    reach = max(0, max(len(a), len(b)) // 2 - 1)
    used, found = [False] * len(b), []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not used[j] and b[j] == c:
                used[j] = True
                found.append(c)
                break
    m = len(found)
    if not m:
        return 0.0
    other = [b[j] for j in range(len(b)) if used[j]]
    swaps = sum(x != y for x, y in zip(found, other)) / 2
    jaro = (m / len(a) + m / len(b) + (m - swaps) / m) / 3
    prefix = 0
    while prefix < min(4, len(a), len(b)) and a[prefix] == b[prefix]:
        prefix += 1
    return jaro + prefix * 0.1 * (1 - jaro)


def one_edit(a: str, b: str) -> bool:
    """At most one letter inserted, deleted, replaced, or swapped with its neighbour."""
    if abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    x, y = a[i:], b[i:]
    return x[1:] == y[1:] or x[1:] == y or x == y[1:] or (x[:2] == y[1::-1] and len(y) > 1 and x[2:] == y[2:])


def nickname_of(a: str, b: str) -> bool:
    """One is a short form of the other, or both are of one name."""
    x, y = _NICK.get(a, set()) | {a}, _NICK.get(b, set()) | {b}
    return bool(x & y)


def _near(a: str, b: str) -> int:
    """Typing errors between two words: 0, 1, or 9 for different words."""
    if a == b:
        return 0
    if min(len(a), len(b)) >= 4 and one_edit(a, b) and jaro_winkler(a, b) >= MIN_SIMILARITY:
        return 1
    return 0 if nickname_of(a, b) else 9


def _first(word: str) -> set[str]:
    return {word[0]} | {f[0] for f in _NICK.get(word, ())}


def _fits(rest: list[str], initials: list[str], other: list[str]) -> bool:
    """Do the words ``rest`` and ``initials`` of one spelling agree with the initials of another?"""
    if not rest:
        return not initials or not other or initials[0] == other[0]
    if not other or other[0] not in _first(rest[0]):
        return False
    return len(rest) == 1 and (not initials or len(other) == 1 or initials[0] == other[1])


def same_name(a: tuple[bool, list[str], list[str]], b: tuple[bool, list[str], list[str]]) -> bool:
    """Can two parsed spellings name one person or organisation? At most one typing error."""
    (org_a, wa, ia), (org_b, wb, ib) = a, b
    if org_a != org_b or not wa or not wb:
        return False
    if org_a:
        if len(wa) != len(wb):
            return False
        x, y = sorted(wa), sorted(wb)
        for w in list(x):
            if w in y:
                x.remove(w)
                y.remove(w)
        return not x or len(x) == 1 and len(x[0]) > 3 and _near(x[0], y[0]) == 1
    if len(wa) < len(wb) or len(wa) == len(wb) == 1 and len(ia) < len(ib):
        (wa, ia), (wb, ib) = (wb, ib), (wa, ia)
    if len(wb) == 1:
        if not ib and not (len(wa) == 1 and not ia):
            return False  # a bare surname names nobody in particular
        if len(wa) == 1:
            return _near(wa[0], wb[0]) <= 1 and len(wa[0]) > 3 and bool(ia) == bool(ib) and ia[:1] == ib[:1] and (len(ia) < 2 or len(ib) < 2 or ia[1] == ib[1])
        return len(wa) == 2 and any(len(wa[k]) > 3 and _near(wa[k], wb[0]) <= 1 and not (wa[k] in _ALL_GIVEN) and _fits([wa[1 - k]], ia, ib) for k in (0, 1))
    if len(wa) != len(wb):
        return False
    if ia and ib and ia[0] != ib[0]:
        return False
    if len(wa) == 2:
        return any(_near(wa[0], wb[k]) + _near(wa[1], wb[1 - k]) <= 1 for k in (0, 1))
    x, y = sorted(wa), sorted(wb)
    return sum(_near(p, q) for p, q in zip(x, y)) <= 1


_ALL_GIVEN = set(_lists(NICKNAMES)) | set(_NICK)


def _parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        parsed = [parse_name(n) for n in b["name"]]
        yield pd.DataFrame({"name": b["name"], "org": [p[0] for p in parsed], "words": [p[1] for p in parsed], "initials": [p[2] for p in parsed]})


def _forms(word: str) -> set[str]:
    """The word, and the word with one letter left out. Words one edit apart share a form."""
    return {word} | ({word[:i] + word[i + 1 :] for i in range(len(word))} if len(word) > 3 else set())


_SOUNDS = (("sch", "s"), ("sh", "s"), ("ch", "k"), ("ck", "k"), ("ph", "f"), ("th", "t"), ("gh", "g"), ("wh", "w"), ("qu", "k"), ("c", "k"), ("q", "k"), ("z", "s"), ("x", "ks"), ("v", "f"), ("y", "i"), ("j", "i"), ("w", "u"), ("d", "t"))


@lru_cache(maxsize=65_536)
def phonetic(word: str) -> str:
    """The phonetic code of a folded word: its first sound and its consonants, alike ones merged."""
    for a, b in _SOUNDS:
        word = word.replace(a, b)
    return word[:1] + re.sub(r"(.)\1+", r"\1", re.sub("[aeiouh'’-]", "", word[1:]))


@lru_cache(maxsize=65_536)
def _form_codes(word: str) -> frozenset[str]:
    return frozenset(map(phonetic, _forms(word)))


@lru_cache(maxsize=65_536)
def _name_codes(word: str) -> frozenset[str]:
    """The codes of a word and of the names it is short for."""
    return frozenset(map(phonetic, {word} | _NICK.get(word, set())))


def block_keys(org: bool, words: list[str], initials: list[str]) -> dict[str, bool]:
    """The blocks of one spelling; True where it is to be paired with all others of the block, False
    where only spellings with initials are to be paired with it.

    One word of an organisation may differ: the codes of its other words and of a form of this one
    are the block. Full names (True) are blocked by two words, those of two words also by each
    surname and the initial of the other word (False); spellings of one word by it and the initial."""
    if org:
        return {f"o{' '.join(sorted(map(phonetic, words[:k] + words[k + 1 :])))}#{c}": True for k, w in enumerate(words) for c in _form_codes(w)}
    keys = {}
    if len(words) == 1:
        return {f"i{c}#{(initials or '.')[0]}": True for c in _form_codes(words[0]) | _name_codes(words[0])}
    for k, v in enumerate(words):
        for w in words[k + 1 :]:
            pairs = {(a, b) for a in _name_codes(v) for b in _name_codes(w)}
            if len(words) == 2:
                pairs |= {(a, b) for a in _form_codes(v) for b in _name_codes(w)} | {(a, b) for a in _name_codes(v) for b in _form_codes(w)}
            keys |= {"f" + "|".join(sorted(p)): True for p in pairs}
    if len(words) == 2:
        for k, w in enumerate(words):
            if len(w) > 3 and w not in _ALL_GIVEN:
                keys |= {f"i{c}#{m}": False for c in _form_codes(w) for m in _first(words[1 - k])}
    return keys


def _keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        rows = [
            (k, n, lead) for n, org, w, i in zip(b["name"], b["org"], b["words"], b["initials"])
            for k, lead in block_keys(org, list(w), list(i)).items()
        ]
        yield pd.DataFrame(rows, columns=["key", "name", "lead"])


def _accept(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    seen: dict[str, tuple] = {}

    def get(n: str) -> tuple:
        if n not in seen:
            if len(seen) > 200_000:
                seen.clear()
            seen[n] = parse_name(n)
        return seen[n]

    for b in batches:
        ok = [same_name(get(x), get(y)) for x, y in zip(b["name_a"], b["name_b"])]
        kept = b[ok]
        yield pd.DataFrame({
            "name_a": kept["name_a"], "name_b": kept["name_b"],
            "full_a": [get(x)[0] or len(get(x)[1]) > 1 for x in kept["name_a"]], "full_b": [get(x)[0] or len(get(x)[1]) > 1 for x in kept["name_b"]],
        })


def link_names(names: DataFrame, name: str = "name") -> DataFrame:
    """(name, entity) for every distinct spelling; entity is the least spelling of its class.

    Spellings given by initials link to a person only if all full spellings they agree with are
    one class; an ambiguous initial stays apart rather than merging two people. NULL and blank
    spellings give no row, repeated rows one row, a spelling without letters a class of its own;
    empty input an empty result; other columns are ignored."""
    distinct = names.select(F.col(name).alias("name")).where("name is not null and trim(name) <> ''").distinct()
    parsed = stage(distinct.mapInPandas(_parse, "name string, org boolean, words array<string>, initials array<string>"), "parsed")
    keys = parsed.mapInPandas(_keys, "key string, name string, lead boolean")
    keys = stage(keys.select(F.xxhash64("key").alias("key"), "name", "lead"), "keys")
    pairs = within_blocks(keys, "key", "name", "lead").toDF("name_a", "name_b").distinct()
    links = stage(pairs.mapInPandas(_accept, "name_a string, name_b string, full_a boolean, full_b boolean"), "links")
    full = links.where("full_a and full_b")
    persons = stage(connected_components(full, "name_a", "name_b"), "persons")
    mixed = links.where("full_a <> full_b").select(
        F.when(F.col("full_a"), F.col("name_b")).otherwise(F.col("name_a")).alias("short"),
        F.when(F.col("full_a"), F.col("name_a")).otherwise(F.col("name_b")).alias("long"),
    )
    owners = mixed.join(persons, mixed["long"] == persons["node"], "left").withColumn("owner", F.coalesce("component", "long"))
    one = owners.groupBy("short").agg(F.min("owner").alias("owner"), F.max("owner").alias("last"))
    sure = one.where("owner = last").select(F.col("short").alias("name_a"), F.col("owner").alias("name_b"))
    unsure = one.where("owner <> last").select(F.col("short").alias("name_a"))
    initials = links.where("not full_a and not full_b").select("name_a", "name_b")
    # an ambiguous spelling must not join classes by way of another one given by initials
    initials = initials.join(unsure, "name_a", "left_anti").join(unsure.withColumnRenamed("name_a", "name_b"), "name_b", "left_anti")
    edges = full.select("name_a", "name_b").unionByName(sure).unionByName(initials.select("name_a", "name_b"))
    classes = connected_components(stage(edges, "edges"), "name_a", "name_b")
    return parsed.select("name").join(classes, F.col("name") == F.col("node"), "left").select("name", F.coalesce("component", "name").alias("entity"))


def entity_pairs(classes: DataFrame) -> DataFrame:
    """(name_a, name_b), name_a < name_b: all pairs of spellings of one entity."""
    c = stage(classes, "classes")
    several = c.groupBy("entity").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("entity")
    c = c.join(several, "entity", "left_semi")
    a, b = c.select("entity", F.col("name").alias("name_a")), c.select("entity", F.col("name").alias("name_b"))
    return a.join(b, "entity").where("name_a < name_b").select("name_a", "name_b")
