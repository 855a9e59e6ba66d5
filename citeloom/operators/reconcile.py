"""Resolving documents to papers.

The rules depend on the order of documents and are not transitive, so they are a fold. Papers
and documents that can ever meet share a DOI, an arXiv id, or a title key (authors key where the
title is empty); the connected components of these keys are independent, so each is folded by
itself, in document order, and the components run in parallel."""

from __future__ import annotations

import hashlib
import json
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field, fields
from itertools import groupby
from operator import itemgetter

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeloom.functions.text import AUTHOR, authors_key
from citeloom.operators.components import connected_components
from citeloom.session import small_side, stage

EVIDENCE_JSON = "doi string, arxiv string, title string, title_norm string, authors array<string>, authors_norm array<struct<surname:string,given:string,initial:string>>"
PAPER_JSON = f"id string, {EVIDENCE_JSON}, documents array<string>, year string, reconciliation_conflict array<string>"


def compatible(a: list[dict], b: list[dict]) -> bool:
    """``functions.text.authors_compatible`` for lists of dicts."""

    def pair(x: dict, y: dict) -> bool:
        part = "given" if len(x["given"]) > 1 < len(y["given"]) else "initial"
        return x["surname"] == y["surname"] and x[part] == y[part]

    return bool(a) and len(a) == len(b) and all(map(pair, a, b))


def _full(names: list[dict]) -> int:
    return sum(len(n["given"]) > 1 for n in names)


@dataclass
class Paper:
    """A registry entry; also what a document says about its paper."""

    id: str = ""
    doi: str | None = None
    arxiv: str | None = None
    title: str = ""
    title_norm: str = ""
    authors: list[str] = field(default_factory=list)
    authors_norm: list[dict] = field(default_factory=list)
    documents: list[str] = field(default_factory=list)
    year: str | None = None
    reconciliation_conflict: list[str] | None = None

    @classmethod
    def read(cls, text: str) -> Paper:
        return cls(**{k: v for k, v in json.loads(text).items() if v is not None and k in _FIELDS})

    def contradicts(self, other: Paper) -> bool:
        """Both have a DOI, or both an arXiv id, and they differ."""
        return any(a and b and a != b for a, b in ((self.doi, other.doi), (self.arxiv, other.arxiv)))

    def key(self) -> str:
        return "|".join(f"{a['initial']}:{a['surname']}:{a['given']}" for a in self.authors_norm)


_FIELDS = frozenset(f.name for f in fields(Paper))
_json = json.JSONEncoder(ensure_ascii=False).encode
#: Rows that a folded frame holds at least, unless it is the last.
FRAME_ROWS = 20_000


class Registry:
    """Papers of one component with an index for every way to find them."""

    def __init__(self, papers: list[Paper]) -> None:
        self.papers: dict[str, Paper] = {}
        self.index: dict[tuple[str, str], set[str]] = defaultdict(set)
        for p in papers:
            self.add(p)

    def add(self, p: Paper) -> None:
        self.papers[p.id] = p
        self._note(p)

    def _note(self, p: Paper) -> None:
        for kind in ("doi", "arxiv", "title_norm"):
            if value := getattr(p, kind):
                self.index[kind, value].add(p.id)

    def named(self, kind: str, value: str | None) -> set[str]:
        return self.index.get((kind, value), set()) if value else set()

    def enrich(self, p: Paper, e: Paper, sha: str) -> None:
        """Add the document and what the paper lacks; authors also where more are written out."""
        if sha not in p.documents:
            p.documents.append(sha)
        for kind in ("doi", "arxiv", "title", "title_norm"):
            if not getattr(p, kind):
                setattr(p, kind, getattr(e, kind))
        better = compatible(p.authors_norm, e.authors_norm) and _full(e.authors_norm) > _full(p.authors_norm)
        if e.authors_norm and (not p.authors_norm or better):
            p.authors, p.authors_norm = e.authors, e.authors_norm
        self._note(p)

    def conflict(self, e: Paper, sha: str, candidates: list[str]) -> tuple[str, str]:
        fresh = Paper(**{**vars(e), "id": f"paper:conflict:{sha[:16]}", "documents": [sha], "reconciliation_conflict": candidates})
        self.add(fresh)
        return fresh.id, "conflict"

    def settle(self, found: set[str], status: str, e: Paper, sha: str) -> tuple[str, str]:
        """One candidate without contradiction takes the document; anything else is a conflict."""
        one = next(iter(found))
        if len(found) > 1 or self.papers[one].contradicts(e):
            return self.conflict(e, sha, sorted(found))
        self.enrich(self.papers[one], e, sha)
        return one, status

    def reconcile(self, e: Paper, sha: str) -> tuple[str, str]:
        """(paper id, status) of a document with evidence ``e``."""
        by_arxiv, by_doi = self.named("arxiv", e.arxiv), self.named("doi", e.doi)
        if by_arxiv or by_doi:
            return self.settle(by_arxiv | by_doi, "matched-arxiv" if by_arxiv else "matched-doi", e, sha)
        alike = {i for i in self.named("title_norm", e.title_norm) if not self.papers[i].contradicts(e) and compatible(self.papers[i].authors_norm, e.authors_norm)}
        new = self.new_id(e, sha)
        if alike or new in self.papers:
            return self.settle(alike or {new}, "matched-title-authors", e, sha)
        self.add(Paper(**{**vars(e), "id": new, "documents": [sha], "reconciliation_conflict": None}))
        return new, "new"

    @staticmethod
    def new_id(e: Paper, sha: str) -> str:
        if e.arxiv or e.doi:
            return f"arxiv:{e.arxiv}" if e.arxiv else f"doi:{e.doi}"
        if e.title_norm or e.authors_norm:
            return "paper:" + hashlib.sha256(f"{e.title_norm}\0{e.key()}".encode()).hexdigest()[:16]
        return f"paper:document:{sha[:16]}"


FOLDED = ["kind", "sha", "paper_id", "status", "payload"]


def _fold(rows: Iterable[tuple]) -> Iterator[tuple]:
    """One component: papers first, then documents in order. ``rows`` are (kind, sha, payload) in that order."""
    reg, out = Registry([]), []
    for kind, sha, payload in rows:
        if kind == "paper":
            reg.add(Paper.read(payload))
        else:
            out.append(("document", sha, *reg.reconcile(Paper.read(payload), sha), None))
    yield from out
    for p in reg.papers.values():
        yield "paper", None, p.id, None, _json(vars(p))


def _fold_all(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The components of a partition that is sorted by block, kind (papers first), seq and sha; a component
    may go on in the next part, so many small ones cost no frame each."""
    lines = (line for pdf in parts for line in zip(pdf["block"], pdf["kind"], pdf["sha"], pdf["payload"]))
    out: list[tuple] = []
    for _, rows in groupby(lines, key=itemgetter(0)):
        out.extend(_fold(map(itemgetter(1, 2, 3), rows)))
        if len(out) >= FRAME_ROWS:
            yield pd.DataFrame(out, columns=FOLDED)
            out = []
    if out:
        yield pd.DataFrame(out, columns=FOLDED)


def component_keys(doi: Column, arxiv: Column, title_norm: Column, people: Column) -> Column:
    """The keys through which a paper or document can meet another."""
    weak = F.when(F.coalesce(title_norm, F.lit("")) != "", F.concat(F.lit("t:"), title_norm)).when(F.coalesce(people, F.lit("")) != "", F.concat(F.lit("p:"), people))
    return F.array_compact(F.array(F.concat(F.lit("d:"), F.nullif(doi, F.lit(""))), F.concat(F.lit("a:"), F.nullif(arxiv, F.lit(""))), weak))


def blocks(rows: DataFrame, keys: str = "keys", fallback: str = "own") -> DataFrame:
    """``rows`` with ``block``: equal for rows connected through shared keys. A row without keys is
    its own block, named by its column ``fallback``. Only rows with several keys enter the
    component search; each contributes edges from its first key to the others."""
    edges = stage(rows.where(F.size(keys) > 1).select(F.col(keys)[0].alias("a"), F.explode(F.slice(keys, 2, 10)).alias("b")).distinct(), "keyedges")
    first = F.get(F.col(keys), F.lit(0))
    if edges.isEmpty():  # each key is a block
        return rows.withColumn("block", F.coalesce(first, fallback))
    comp = stage(connected_components(edges), "components")
    return rows.withColumn("_k", first).join(small_side(comp.withColumnRenamed("node", "_k")), "_k", "left").withColumn("block", F.coalesce("component", "_k", fallback)).drop("_k", "component")


def reconcile_documents(papers: DataFrame, documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(assignments, registry): the paper and status of every document, and all papers after it.

    ``papers`` has the columns of the registry (``PAPER_JSON``), ``documents`` sha256, seq (their
    order) and the normalised evidence (``EVIDENCE_JSON``). An empty registry or batch is fine;
    documents repeating a sha256 are folded each. A component is one task: its rules depend on
    order, so it cannot be divided; documents without any evidence never share one."""
    p = papers.select(*[c.strip().split(" ")[0] for c in _columns(PAPER_JSON)])
    people = authors_key(F.col("authors_norm"))
    left = p.select(
        F.lit("paper").alias("kind"), F.lit(None).cast("string").alias("sha"), F.lit(0).cast("long").alias("seq"), F.to_json(F.struct("*")).alias("payload"),
        component_keys(F.col("doi"), F.col("arxiv"), F.col("title_norm"), people).alias("keys"), F.concat(F.lit("P"), "id").alias("own"),
    )
    e = documents.select("sha256", "seq", *[c.strip().split(" ")[0] for c in _columns(EVIDENCE_JSON)])
    right = e.select(
        F.lit("document").alias("kind"), F.col("sha256").alias("sha"), F.col("seq").cast("long").alias("seq"), F.to_json(F.struct("doi", "arxiv", "title", "title_norm", "authors", "authors_norm")).alias("payload"),
        component_keys(F.col("doi"), F.col("arxiv"), F.col("title_norm"), people).alias("keys"), F.concat(F.lit("D"), "sha256").alias("own"),
    )
    rows = blocks(stage(left.unionByName(right), "reconcile"))
    # components no new document belongs to stay as they are and skip the fold
    touched = rows.where("kind = 'document'").select("block").distinct()
    done = stage(
        rows.join(touched, "block", "left_semi").select("block", "kind", "seq", "sha", "payload")
        .repartition("block").sortWithinPartitions("block", F.col("kind") != "paper", F.asc_nulls_last("seq"), F.asc_nulls_last("sha"))
        .mapInPandas(_fold_all, "kind string, sha string, paper_id string, status string, payload string"),
        "folded",
    )
    rest = rows.join(touched, "block", "left_anti").where("kind = 'paper'").select("payload")
    registry = done.where("kind = 'paper'").select("payload").unionByName(rest).select(F.from_json("payload", PAPER_JSON).alias("p")).select("p.*")
    return done.where("kind = 'document'").select(F.col("sha").alias("sha256"), "paper_id", F.col("status").alias("reconciliation")), registry


def _columns(ddl: str) -> list[str]:
    """The column definitions of a DDL string, commas within angle brackets kept."""
    out, depth = [""], 0
    for ch in ddl:
        depth += (ch == "<") - (ch == ">")
        if ch == "," and not depth:
            out.append("")
        else:
            out[-1] += ch
    return out


__all__ = ["AUTHOR", "Paper", "Registry", "blocks", "compatible", "component_keys", "reconcile_documents"]
