"""Titles and person names as comparison keys. Everything is a Column expression inside the JVM;
only strings with characters outside ASCII pass through one Arrow UDF, because Spark has no
Unicode compatibility normalisation or case folding."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The dashes that count as a hyphen, and punctuation that titles lose (fixed values).
DASHES = "‐‑‒–—−"
TITLE_PUNCTUATION = ",;:!?()[]{}\"'“”‘’"
NAME_SUFFIXES = ("jr", "sr", "ii", "iii", "iv")
NO_AUTHOR = ("", "et al", "et al.", "and")

AUTHOR = T.StructType([T.StructField("surname", T.StringType()), T.StructField("given", T.StringType()), T.StructField("initial", T.StringType())])

_DASH_TO_HYPHEN = {ord(c): "-" for c in DASHES}


def py_fold(s: str) -> str:
    """Compatibility form, dashes as hyphens, case folded."""
    return unicodedata.normalize("NFKC", s).translate(_DASH_TO_HYPHEN).casefold()


@F.pandas_udf(T.StringType())
def _fold_udf(s: pd.Series) -> pd.Series:
    return s.map(py_fold, na_action="ignore")


def fold(c: Column) -> Column:
    """``py_fold`` of a column; plain ASCII strings are lowered without leaving the JVM."""
    ascii_only = c.rlike(r"^\p{ASCII}*$")
    return F.when(ascii_only, F.lower(c)).otherwise(_fold_udf(F.when(~ascii_only, c)))


def title_key(folded: Column) -> Column:
    """The title key of an already folded title."""
    marks = F.translate(folded, TITLE_PUNCTUATION, " " * len(TITLE_PUNCTUATION))
    no_dots = F.regexp_replace(marks, r"(?U)\.(?=\s|$)", " ")
    return F.trim(F.regexp_replace(no_dots, r"(?U)\s+", " "))


def normalize_title(c: Column) -> Column:
    """Titles that differ in case, punctuation, dashes or spacing become equal; hyphens,
    ampersands and inner dots stay. NULL counts as empty."""
    return title_key(fold(F.coalesce(c, F.lit(""))))


def name_words(folded: Column) -> Column:
    """The words of an already folded name: Latin letters, apostrophes and hyphens."""
    s = F.regexp_replace(folded, r"[\p{Nd}*†‡§]+", "")
    s = F.regexp_replace(F.replace(s, F.lit("."), F.lit(" ")), r"[^a-z0-9À-ɏḀ-ỿ'\- ]+", " ")
    return F.filter(F.split(s, r"\s+"), lambda w: w != "")


def _author(surname: Column, given: Column) -> Column:
    return F.struct(surname.alias("surname"), given.alias("given"), F.substring(given, 1, 1).alias("initial"))


def author_struct(folded: Column) -> Column:
    """(surname, given, initial) of one folded author; NULL if it does not name a person.

    With exactly one comma and a single word before it that word is the surname; otherwise the
    first word is the given name and the last, without suffixes like "jr", the surname."""
    s = F.regexp_replace(folded, r"(?U)^\s+|\s+$", "")
    halves = F.split(s, ",")
    left, right = name_words(halves[0]), name_words(F.get(halves, F.lit(1)))
    words = name_words(s)
    suffixed = F.element_at(words, -1).isin(*NAME_SUFFIXES) & (F.size(words) >= 3)
    core = F.when(suffixed, F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0)))).otherwise(words)
    return (
        F.when(s.isNull() | s.isin(*NO_AUTHOR), F.lit(None))
        .when((F.size(halves) == 2) & (F.size(left) == 1) & (F.size(right) > 0), _author(F.get(left, F.lit(0)), F.get(right, F.lit(0))))
        .when(F.size(words) < 2, F.lit(None))
        .otherwise(_author(F.get(core, F.size(core) - 1), F.get(core, F.lit(0))))
    )


def names_person(folded: Column) -> Column:
    """Would ``author_struct`` find an author? All its ways to one need two words."""
    s = F.regexp_replace(folded, r"(?U)^\s+|\s+$", "")
    return ~s.isin(*NO_AUTHOR) & (F.size(name_words(s)) >= 2)


def normalize_author(c: Column) -> Column:
    return author_struct(fold(c))


_STRONG = r"(?iU)\s*;\s*|\s+\band\b\s+|\s*[·•]\s*"


def parse_author_string(c: Column) -> Column:
    """The authors of one string: split at semicolons, "and" and bullets if it has any, else at
    commas. Parts that name nobody are dropped; NULL and "" give no author."""
    f = F.regexp_replace(fold(F.coalesce(c, F.lit(""))), r"(?U)^\s+|\s+$", "")
    parts = F.when(f.rlike(r"(?iU);|\s+\band\b\s+|[·•]"), F.split(f, _STRONG)).otherwise(F.split(f, ","))
    return F.filter(F.transform(parts, author_struct), lambda a: a.isNotNull())


def parse_author_array(c: Column) -> Column:
    """The authors of a list of strings; items that name nobody are dropped."""
    folded = F.split(fold(F.array_join(F.coalesce(c, F.array().cast("array<string>")), "\u0000")), "\u0000")
    return F.filter(F.transform(folded, author_struct), lambda a: a.isNotNull())


def author_compatible(a: Column, b: Column) -> Column:
    """Same surname, and the same given name where both are written out, else the same initial."""
    both_full = (F.length(a["given"]) > 1) & (F.length(b["given"]) > 1)
    return (a["surname"] == b["surname"]) & F.when(both_full, a["given"] == b["given"]).otherwise(a["initial"] == b["initial"])


def authors_compatible(a: Column, b: Column) -> Column:
    """Two non-empty lists of the same length that are compatible author by author."""
    pairwise = F.forall(F.zip_with(a, b, author_compatible), lambda x: F.coalesce(x, F.lit(False)))
    return F.coalesce((F.size(a) > 0) & (F.size(a) == F.size(b)) & pairwise, F.lit(False))


def authors_key(a: Column) -> Column:
    """``initial:surname:given`` of every author, joined by bars."""
    return F.array_join(F.transform(a, lambda x: F.concat_ws(":", x["initial"], x["surname"], x["given"])), "|")


def full_given_names(a: Column) -> Column:
    """How many authors have a given name of more than an initial."""
    return F.size(F.filter(a, lambda x: F.length(x["given"]) > 1))
