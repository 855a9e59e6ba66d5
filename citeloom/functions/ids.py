"""DOIs, arXiv ids and dates as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from citeloom.functions.text import authors_key, fold

#: Identifier formats (fixed values).
DOI = r"(?iU)\b10\.[0-9]{4,9}/[-._;()/:A-Z0-9]+\b"
ARXIV_ID = r"([0-9]{4}\.[0-9]{4,5}|[a-z][a-z0-9.-]+/[0-9]{7})(v[0-9]+)?"
ARXIV_MARKED = r"(?iU)arxiv\s*:\s*" + ARXIV_ID
ARXIV_BROKEN = r"(?iU)https?://arxiv\.org/(?:abs|pdf)/([0-9]{4})\.\s+([0-9]{4,5})(v[0-9]+)?"
ARXIV_BARE = r"(?U)\b([0-9]{4}\.[0-9]{4,5})(v[0-9]+)?\b"


def _some(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def normalize_doi(c: Column) -> Column:
    """The first DOI of a string, folded, without closing punctuation; NULL if there is none."""
    return _some(F.rtrim(F.regexp_extract(fold(c), DOI, 0), F.lit(".,;:)]}")))


def extract_doi(c: Column) -> Column:
    """The first DOI of a text; what follows from characters that only compatibility
    normalisation would turn into DOI characters is not part of it."""
    return _some(F.rtrim(F.lower(F.regexp_extract(c, DOI, 0)), F.lit(".,;:)]}")))


def _id(base: Column, version: Column) -> Column:
    return F.when(base != "", F.struct(F.lower(base).alias("base"), _some(F.lower(version)).alias("version")))


def normalize_arxiv(c: Column) -> Column:
    """(base, version) of the first arXiv id anywhere in a string; NULL if there is none."""
    f = fold(c)
    return _id(F.regexp_extract(f, ARXIV_ID, 1), F.regexp_extract(f, ARXIV_ID, 2))


def marked_arxiv(c: Column) -> Column:
    """(base, version) of the first id that is marked ``arXiv:``."""
    return _id(F.regexp_extract(c, ARXIV_MARKED, 1), F.regexp_extract(c, ARXIV_MARKED, 2))


def repaired_arxiv(c: Column) -> Column:
    """(base, version) of an arxiv.org address that a blank or line break tears after the dot."""
    year, number = F.regexp_extract(c, ARXIV_BROKEN, 1), F.regexp_extract(c, ARXIV_BROKEN, 2)
    return _id(F.when(year != "", F.concat_ws(".", year, number)).otherwise(""), F.regexp_extract(c, ARXIV_BROKEN, 3))


def bare_arxiv(c: Column) -> Column:
    """(base, version) of the first new-style id without any mark."""
    return _id(F.regexp_extract(c, ARXIV_BARE, 1), F.regexp_extract(c, ARXIV_BARE, 2))


def extract_arxiv(c: Column, repair: Column | bool = True) -> Column:
    """A marked id, else (where ``repair`` holds) a repaired one."""
    return F.coalesce(marked_arxiv(c), F.when(F.lit(repair) if isinstance(repair, bool) else repair, repaired_arxiv(c)))


def citation_arxiv(c: Column) -> Column:
    """The arXiv id of a citation: marked; repaired unless it has a DOI; else bare."""
    return F.coalesce(extract_arxiv(c, extract_doi(c).isNull()), bare_arxiv(c))


def arxiv_month(base: Column) -> Column:
    """``YYYY-MM`` of a new-style id; years from 80 on are of the last century."""
    yy = F.regexp_extract(base, r"([0-9]{2})([0-9]{2})\.[0-9]+", 1)
    mm = F.regexp_extract(base, r"([0-9]{2})([0-9]{2})\.[0-9]+", 2)
    return F.when(yy != "", F.concat(F.when(yy.cast("int") < 80, "20").otherwise("19"), yy, F.lit("-"), mm))


def stamp_date(c: Column) -> Column:
    """``1 Jul 2022`` or ``1 July 2022`` as an ISO date; NULL for anything else."""
    s = F.initcap(F.lower(F.regexp_replace(c, r"(?U)^\s+|\s+$", "")))
    s = F.regexp_replace(s, r"(?U)\s+", " ")
    parsed = F.coalesce(F.try_to_date(s, "d MMM yyyy"), F.try_to_date(s, "d MMMM yyyy"))
    return F.date_format(parsed, "yyyy-MM-dd")


def new_paper_id(doi: Column, arxiv: Column, title_norm: Column, authors_norm: Column, sha256: Column) -> Column:
    """The id of a paper first seen in a document: by arXiv id, DOI, hash of title and authors, or
    hash of the document, whichever is there first."""
    title, people = F.coalesce(title_norm, F.lit("")), F.coalesce(authors_key(authors_norm), F.lit(""))
    mixed = F.substring(F.sha2(F.concat(title, F.lit("\u0000"), people), 256), 1, 16)
    return F.coalesce(
        F.concat(F.lit("arxiv:"), _some(arxiv)), F.concat(F.lit("doi:"), _some(doi)),
        F.when((title != "") | (people != ""), F.concat(F.lit("paper:"), mixed)), F.concat(F.lit("paper:document:"), F.substring(sha256, 1, 16)),
    )


def stub_paper_id(doi: Column, arxiv: Column) -> Column:
    """The id of a paper first seen in a citation: here the DOI goes first."""
    return F.coalesce(F.concat(F.lit("doi:"), _some(doi)), F.concat(F.lit("arxiv:"), _some(arxiv)))
