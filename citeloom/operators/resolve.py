"""Resolving citations to papers: first by identifiers, then by title and authors of citations
that identifiers have resolved (anchors)."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeloom.functions.ids import normalize_arxiv, normalize_doi
from citeloom.operators.reconcile import blocks
from citeloom.session import small_side, stage

ANCHOR = "title_authors_anchor"
STRONG = ("doi", "arxiv")


def strong_ids(df: DataFrame) -> DataFrame:
    """``df`` with ``_doi`` and ``_arxiv``, its identifiers normalised again."""
    return df.withColumns({"_doi": normalize_doi(F.col("doi")), "_arxiv": normalize_arxiv(F.col("arxiv"))["base"]})


def has_strong_ids(df: DataFrame) -> Column:
    return normalize_doi(F.col("doi")).isNotNull() | normalize_arxiv(F.col("arxiv")).isNotNull()


def strong_matches(refs: DataFrame, papers: DataFrame, key: list[str]) -> DataFrame:
    """(*key, paper_id, via): the papers that share an identifier with a citation; ``doi`` where
    both identifiers lead to the same paper. Two equi-joins, no theta join."""
    r = strong_ids(refs).select(*key, "_doi", "_arxiv")
    p = strong_ids(papers).select(F.col("id").alias("pid"), "_doi", "_arxiv")
    hits = [
        r.where(F.col(c).isNotNull()).join(p.where(F.col(c).isNotNull()).select("pid", c), c).select(*key, F.col("pid").alias("paper_id"), F.lit(rank).alias("rank"))
        for rank, c in enumerate(("_doi", "_arxiv"))
    ]
    both = hits[0].unionByName(hits[1]).groupBy(*key, "paper_id").agg(F.min("rank").alias("rank"))
    return both.select(*key, "paper_id", F.when(F.col("rank") == 0, "doi").otherwise("arxiv").alias("via"))


def current_strong(refs: DataFrame, papers: DataFrame, key: list[str]) -> DataFrame:
    """The ``key`` of the citations whose stored resolution by identifiers still holds: exactly one
    paper matches, it is the stored one, and no identifier of the two contradicts."""
    claimed = strong_ids(refs.where((F.col("status") == "resolved") & F.col("resolved_via").isin(*STRONG)))
    matches = strong_matches(claimed.drop("_doi", "_arxiv"), papers, key).groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.min("paper_id").alias("match"))
    p = strong_ids(papers).select(F.col("id").alias("match"), F.col("_doi").alias("p_doi"), F.col("_arxiv").alias("p_arxiv"))
    clash = F.coalesce(F.col("_doi") != F.col("p_doi"), F.lit(False)) | F.coalesce(F.col("_arxiv") != F.col("p_arxiv"), F.lit(False))
    return claimed.join(matches.where("n = 1"), key).where("paper_id = match").join(p, "match").where(~clash).select(*key)


class Shelf:
    """The papers of one block while citations are folded into them."""

    def __init__(self) -> None:
        self.ids: dict[str, list[str | None]] = {}  # paper -> [doi, arxiv]
        self.by: tuple[dict[str, set[str]], dict[str, set[str]]] = ({}, {})
        self.touched: dict[str, str | None] = {}  # papers changed or made, with the year of new ones
        self.new: set[str] = set()

    def put(self, paper: str, doi: str | None, arxiv: str | None) -> None:
        have = self.ids.setdefault(paper, [None, None])
        for k, value in enumerate((doi, arxiv)):
            if value and not have[k]:
                have[k] = value
                self.by[k].setdefault(value, set()).add(paper)

    def matches(self, doi: str | None, arxiv: str | None) -> dict[str, str]:
        found = dict.fromkeys(self.by[1].get(arxiv, ()), "arxiv")
        found.update(dict.fromkeys(self.by[0].get(doi, ()), "doi"))
        return found

    def clash(self, paper: str, doi: str | None, arxiv: str | None) -> bool:
        return any(a and b and a != b for a, b in zip(self.ids[paper], (doi, arxiv)))

    def resolve(self, doi: str | None, arxiv: str | None, year: str | None) -> tuple[str | None, str | None]:
        """The paper of a citation, made if none has its identifiers; (None, None) where it would
        contradict a paper or fits several."""
        found = self.matches(doi, arxiv)
        if len(found) > 1:
            return None, None
        if found:
            (paper, via), = found.items()
        else:
            via = "doi" if doi else "arxiv"  # as functions.ids.stub_paper_id
            paper = f"{via}:{doi or arxiv}"
        if paper in self.ids:
            if self.clash(paper, doi, arxiv):
                return None, None
            before = list(self.ids[paper])
            self.put(paper, doi, arxiv)
            if self.ids[paper] != before:
                self.touched.setdefault(paper, None)
        else:
            self.put(paper, doi, arxiv)
            self.touched[paper] = year
            self.new.add(paper)
        return paper, via


def _fold(pdf: pd.DataFrame) -> pd.DataFrame:
    shelf, rows = Shelf(), []
    none = lambda x: None if pd.isna(x) else x
    for p in pdf[pdf["kind"] == "paper"].itertuples():
        shelf.put(p.id, none(p.d), none(p.a))
    for r in pdf[pdf["kind"] == "ref"].sort_values(["doc_seq", "ord"]).itertuples():
        doi, arxiv, kept = none(r.d), none(r.a), none(r.kept)
        if kept is not None and shelf.matches(doi, arxiv).keys() == {kept} and not shelf.clash(kept, doi, arxiv):
            rows.append(("ref", r.id, kept, none(r.kept_via), None, None, None))
        else:
            rows.append(("ref", r.id, *shelf.resolve(doi, arxiv, none(r.year)), None, None, None))
    rows += [("new" if p in shelf.new else "paper", p, p, None, *shelf.ids[p], y) for p, y in shelf.touched.items()]
    return pd.DataFrame(rows, columns=["kind", "id", "paper_id", "via", "d", "a", "year"])


def resolve_strong(refs: DataFrame, papers: DataFrame, manifest: DataFrame, key: str = "ref_id") -> tuple[DataFrame, DataFrame]:
    """(resolutions, papers): (key, paper_id, resolved_via) of the citations that identifiers
    resolve, and the papers with what the pass added: missing identifiers and new stubs.

    Only citations of documents whose own paper is known take part, in the order of ``doc_seq``
    and ``ref_index``. Citations resolved by title and authors without identifiers are left
    for the next pass. Where every identifier of a block belongs to one paper that has them
    all, which is the rule, or all citations of a block name one work that no paper has yet, joins
    decide; only the other blocks are folded in order."""
    sources = manifest.where("paper_id is not null").select("doc_sha", F.col("paper_id").alias("id")).join(papers.select("id"), "id", "left_semi").select("doc_sha").distinct()
    r = strong_ids(refs.join(sources, "doc_sha", "left_semi")).where("_doi is not null or _arxiv is not null")
    held = (F.col("status") == "resolved") & F.col("resolved_via").isin(*STRONG)
    left = strong_ids(papers).where("_doi is not null or _arxiv is not null").select(
        F.lit("paper").alias("kind"), "id", F.col("_doi").alias("d"), F.col("_arxiv").alias("a"), F.lit(None).cast("string").alias("year"), F.lit(None).cast("string").alias("kept"),
        F.lit(None).cast("string").alias("kept_via"), F.lit(0).cast("long").alias("doc_seq"), F.lit(0).cast("long").alias("ord"),
    )
    right = r.select(
        F.lit("ref").alias("kind"), F.col(key).cast("string").alias("id"), F.col("_doi").alias("d"), F.col("_arxiv").alias("a"), "year",
        F.when(held, F.col("paper_id")).alias("kept"), F.when(held, F.col("resolved_via")).alias("kept_via"),
        F.col("doc_seq").cast("long").alias("doc_seq"), F.col("ref_index").cast("long").alias("ord"),
    )
    # citations with the same identifiers share a block, so blocks are sought among the distinct ones
    keys = F.array_compact(F.array(F.concat(F.lit("d:"), "d"), F.concat(F.lit("a:"), "a")))
    right = stage(right, "ids")
    stub = F.when(F.col("d").isNotNull(), F.concat(F.lit("doi:"), "d")).otherwise(F.concat(F.lit("arxiv:"), "a"))  # as functions.ids.stub_paper_id
    via = F.when(F.col("d").isNotNull(), "doi").otherwise("arxiv")
    # what a citation keeps differs from what it would get by itself only in the way it was resolved
    own_way = (F.col("kept") == stub) & ~F.col("kept_via").eqNullSafe(via)
    pairs = right.groupBy("d", "a").agg(F.count(F.lit(1)).alias("refs"), F.count_if(own_way).alias("own_way"))
    none = F.lit(None).cast("string")
    seen = pairs.select("d", "a", none.alias("id"), "refs", "own_way").unionByName(left.select("d", "a", "id", F.lit(0).cast("long").alias("refs"), F.lit(0).cast("long").alias("own_way")))
    seen = stage(blocks(stage(seen.withColumn("keys", keys).withColumn("own", none), "pairs")).drop("keys", "own"), "blocks")
    paper = F.col("id").isNotNull()
    shape = seen.groupBy("block").agg(
        F.count_if(paper).alias("papers"), F.min("id").alias("paper"), F.min(F.when(paper, F.col("d"))).alias("pd"), F.min(F.when(paper, F.col("a"))).alias("pa"),
        F.min("d").alias("d0"), F.max("d").alias("d1"), F.min("a").alias("a0"), F.max("a").alias("a1"), F.sum("refs").alias("refs"), F.sum("own_way").alias("own_way"), F.count_if(F.col("d").isNull()).alias("no_d"),
    )
    alike = F.col("d0").eqNullSafe(F.col("d1")) & F.col("a0").eqNullSafe(F.col("a1"))
    full = (F.col("papers") == 1) & alike & F.col("pd").eqNullSafe(F.col("d0")) & F.col("pa").eqNullSafe(F.col("a0"))
    # citations of one work that no paper has yet: the first makes the stub, and its id does not depend on which that is
    fresh = (F.col("papers") == 0) & alike & ((F.col("no_d") == 0) | F.col("d0").isNull()) & (F.col("own_way") == 0)
    shape = shape.where("refs > 0").select("block", F.coalesce("paper", F.when(F.col("d0").isNotNull(), F.concat(F.lit("doi:"), "d0")).otherwise(F.concat(F.lit("arxiv:"), "a0"))).alias("paper"), "d0", "a0", F.coalesce(full, F.lit(False)).alias("full"), F.coalesce(fresh, F.lit(False)).alias("fresh"))
    shape = stage(shape, "shape")
    found = stage(seen.where("id is null").select("d", "a", "block").join(shape, "block").select("d", "a", "block", "paper", "full", "fresh"), "found")
    same = F.col("x.d").eqNullSafe(F.col("y.d")) & F.col("x.a").eqNullSafe(F.col("y.a"))
    of = lambda which: right.alias("x").join(small_side(found.where(which)).alias("y"), same).select("x.*", "y.block", "y.paper", "y.fresh")
    rows = of("full or fresh")
    easy = rows.select("id", F.col("paper").alias("paper_id"), F.when(F.col("kept") == F.col("paper"), F.col("kept_via")).otherwise(via).alias("via"))
    at = F.struct(F.col("doc_seq").isNull(), "doc_seq", F.col("ord").isNull(), "ord")
    first = rows.where("fresh").groupBy("block").agg(F.min_by("year", at).alias("year"))
    stubs = shape.where("fresh").join(first, "block").select(F.lit("new").alias("kind"), F.col("paper").alias("id"), F.col("paper").alias("paper_id"), none.alias("via"), F.col("d0").alias("d"), F.col("a0").alias("a"), "year")
    open_ = shape.where("not full and not fresh")
    papers_in = left.join(seen.where("id is not null").select("id", "d", "a", "block").distinct().join(open_.select("block"), "block", "left_semi").withColumnsRenamed({"d": "_d", "a": "_a", "id": "_i"}), (F.col("id") == F.col("_i")) & F.col("d").eqNullSafe(F.col("_d")) & F.col("a").eqNullSafe(F.col("_a"))).select(*left.columns, "block")
    hard = stage(
        of("not full and not fresh").select(*left.columns, "block").unionByName(papers_in).groupBy("block")
        .applyInPandas(_fold, "kind string, id string, paper_id string, via string, d string, a string, year string"),
        "resolved",
    )
    resolved = easy.unionByName(hard.where("kind = 'ref' and paper_id is not null").select("id", "paper_id", "via"))
    changed = hard.where("kind <> 'ref'").unionByName(stubs).select(F.col("id").alias("cid"), F.col("d"), F.col("a"), F.col("year").alias("y"), (F.col("kind") == "new").alias("fresh"))
    old = papers.join(changed.where("not fresh"), papers["id"] == F.col("cid"), "left").withColumns({
        "doi": F.when(F.coalesce("doi", F.lit("")) == "", F.coalesce("d", "doi")).otherwise(F.col("doi")),
        "arxiv": F.when(F.coalesce("arxiv", F.lit("")) == "", F.coalesce("a", "arxiv")).otherwise(F.col("arxiv")),
    }).select(*papers.columns)
    kinds = dict(papers.dtypes)
    blank = {"id": F.col("cid"), "doi": F.col("d"), "arxiv": F.col("a"), "title": F.lit(""), "title_norm": F.lit(""), "year": F.col("y")}
    empty = {"authors", "authors_norm", "documents"}
    stubs = changed.where("fresh").select(*[
        (blank[c] if c in blank else F.array() if c in empty else F.lit(None)).cast(kinds[c]).alias(c) for c in papers.columns
    ])
    return resolved.select(F.col("id").cast(dict(refs.dtypes)[key]).alias(key), "paper_id", F.col("via").alias("resolved_via")), old.unionByName(stubs)


def complete_evidence(df: DataFrame) -> Column:
    """Title, authors, and no "et al."."""
    return (F.coalesce("title_norm", F.lit("")) != "") & (F.size(F.coalesce("authors_norm", F.array())) > 0) & F.coalesce("authors_complete", F.lit(False))


def _match_keys(df: DataFrame) -> DataFrame:
    return df.withColumns({"_s": F.transform("authors_norm", lambda x: x["surname"]), "_i": F.transform("authors_norm", lambda x: x["initial"]), "_g": F.transform("authors_norm", lambda x: x["given"])})


def anchor_candidates(refs: DataFrame, anchors: DataFrame, key: str | list[str] = "ref_id") -> DataFrame:
    """(*key, n_candidates, paper_id): how many different papers have an anchor with the same title
    key and compatible authors, and the least of them; ``key`` names a citation.

    Compatible authors have equal surnames and initials, so these are equi-join keys; only the
    given names are left to compare. Each way in which citations write a title and its authors meets
    the anchors once, not each citation: a title with many anchors and many citations costs their
    sum, not their product."""
    keys = [key] if isinstance(key, str) else key
    own = ["title_norm", "_s", "_i", "_g"]
    a = _match_keys(anchors.where(complete_evidence(anchors))).select("title_norm", "_s", "_i", F.col("_g").alias("_ag"), F.col("paper_id").alias("anchor_paper")).distinct()
    r = _match_keys(refs.where(complete_evidence(refs))).select(*keys, *own)
    fits = F.forall(F.zip_with("_g", "_ag", lambda x, y: (F.length(x) == 1) | (F.length(y) == 1) | (x == y)), lambda ok: ok)
    met = r.select(*own).distinct().join(a, ["title_norm", "_s", "_i"]).where(fits).groupBy(*own).agg(F.count_distinct("anchor_paper").alias("n_candidates"), F.min("anchor_paper").alias("paper_id"))
    met = stage(met.withColumn("_h", F.xxhash64("paper_id")), "met")
    # one row for a key, also where it is repeated with other evidence; different papers make it ambiguous
    n = F.when(F.min("_h") != F.max("_h"), F.greatest(F.max("n_candidates"), F.lit(2).cast("long"))).otherwise(F.max("n_candidates"))
    return r.join(small_side(met), own).groupBy(*keys).agg(n.alias("n_candidates"), F.min("paper_id").alias("paper_id"))


def anchor_set(refs: DataFrame, papers: DataFrame, key: str = "ref_id") -> DataFrame:
    """The citations that anchor a paper: currently resolved by identifiers, evidence complete."""
    return refs.where(complete_evidence(refs)).join(current_strong(refs, papers, [key]), key, "left_semi")


def resolve_anchored(refs: DataFrame, papers: DataFrame, key: str = "ref_id") -> DataFrame:
    """(key, outcome, paper_id) of the citations without identifiers that are not resolved
    otherwise: ``unique`` with its paper, ``ambiguous`` or ``no_match``; ``incomplete`` where the
    evidence does not allow the attempt. Never makes a paper."""
    open_ = refs.where(~has_strong_ids(refs)).where((F.coalesce("status", F.lit("")) != "resolved") | F.col("resolved_via").eqNullSafe(F.lit(ANCHOR)))
    able = complete_evidence(open_)
    found = anchor_candidates(open_, anchor_set(refs, papers, key), key)
    out = open_.select(key, able.alias("able")).join(found, key, "left")
    outcome = (
        F.when(~F.col("able"), "incomplete").when(F.col("n_candidates").isNull(), "no_match").when(F.col("n_candidates") == 1, "unique").otherwise("ambiguous")
    )
    return out.select(key, outcome.alias("outcome"), F.when(F.col("n_candidates") == 1, F.col("paper_id")).alias("paper_id"))


def apply_resolutions(refs: DataFrame, strong: DataFrame, papers: DataFrame, manifest: DataFrame, key: str = "ref_id") -> DataFrame:
    """``refs`` after the strong pass: citations in scope get their new resolution or lose a stale
    one; anchored citations without identifiers and citations out of scope stay."""
    sources = manifest.where("paper_id is not null").select("doc_sha", F.col("paper_id").alias("id")).join(papers.select("id"), "id", "left_semi").select("doc_sha").distinct().withColumn("_in", F.lit(True))
    s = strong.select(key, F.col("paper_id").alias("_p"), F.col("resolved_via").alias("_v"))
    anchored = (F.col("resolved_via").eqNullSafe(F.lit(ANCHOR))) & ~has_strong_ids(refs)
    j = refs.withColumn("_anch", anchored).join(sources, "doc_sha", "left").join(s, key, "left")
    keep = F.col("_in").isNull() | F.col("_anch")
    return j.withColumns({
        "status": F.when(keep, F.col("status")).when(F.col("_p").isNotNull(), "resolved"),
        "resolved_via": F.when(keep, F.col("resolved_via")).otherwise(F.col("_v")),
        "paper_id": F.when(keep, F.col("paper_id")).otherwise(F.col("_p")),
    }).select(*refs.columns)


def apply_anchored(refs: DataFrame, anchored: DataFrame, key: str = "ref_id") -> DataFrame:
    """``refs`` after the fallback pass; an anchored resolution that no longer holds is cleared."""
    a = anchored.select(key, F.col("outcome").alias("_o"), F.col("paper_id").alias("_p"))
    stale = F.col("resolved_via").eqNullSafe(F.lit(ANCHOR))
    hit = F.col("_o").eqNullSafe(F.lit("unique"))
    return refs.join(a, key, "left").withColumns({
        "status": F.when(hit, "resolved").when(~stale, F.col("status")),
        "paper_id": F.when(hit, F.col("_p")).when(~stale, F.col("paper_id")),
        "resolved_via": F.when(hit, ANCHOR).when(~stale, F.col("resolved_via")),
    }).select(*refs.columns)
