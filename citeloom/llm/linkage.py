"""Problem 5: matching citations to papers without keys, by collective graph linkage.

Citations and papers that share rare attributes (surname and year, neighbouring title words,
neighbouring authors) span a candidate graph whose edges weigh
what the shared attributes are worth. Meta-blocking drops the edges that are weak for their
citation, the rest are compared in full. Citations that then fit no paper are tried again with all
their attributes and without dropping any edge. Similarity then spreads along the graph until
nothing changes: an edge takes that of the same citation with other rows of the same paper, and an
edge that is almost sure is lifted if a document with that citation surely cites another paper of
the same authors, which may make its own neighbours sure in turn."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from hashlib import blake2b
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from citeloom.llm.lookalikes import _IGNORABLE, _TO_LATIN, script
from citeloom.llm.names import _forms, fold, one_edit, parse_name, same_name
from citeloom.llm.survivors import group_papers
from citeloom.operators.packed import split_packed
from citeloom.session import small_side, stage

#: Words too general to identify a title (fixed values).
STOP_WORDS = frozenset("a an and are as at between by for from how in into is its of on or that the their to towards under via view with without study lessons".split())
#: Words that set one part of a series apart from another (fixed values).
SERIES_WORDS = frozenset("part volume vol sequel ii iii iv two three four second third 2 3 4".split())
#: A key with more pairs than this is refined by a second attribute (see ``citation_tokens``).
MAX_KEY_PAIRS = 50_000
#: So is a key that more papers have than this: the others give each citation so many pairs at most,
#: however large the tables are.
MAX_KEY_ROWS = 64
#: The most frequent words of the papers, by which citations choose rare ones; it decides nothing else.
COMMON_WORDS = 20_000
#: An edge weaker than this part of the citation's strongest is dropped.
EDGE_SHARE = 0.15
MIN_CONFIDENCE = 0.6
SEP = "\u0002"
#: Edges from this confidence on may be lifted by their neighbours, by so much at most.
BORDER, LIFT = 0.55, 0.06


@lru_cache(maxsize=40_000)
def title_tokens(title: str | None) -> tuple[str, ...]:
    """The words of a title, folded, with look-alike letters and line-end hyphens undone."""
    if not title:
        return ()
    s = _IGNORABLE.sub("", title)
    s = re.sub(r"(?<=[^\W\d_])[-‐­]\s+(?=[^\W\d_])", "", s)

    def latin(m: re.Match) -> str:
        w = m.group()
        return "".join(_TO_LATIN.get(c, c) for c in w) if any(script(c) == "L" for c in w) else w

    return tuple(re.findall(r"[^\W_]+", fold(re.sub(r"[^\W\d_]+", latin, s))))


@lru_cache(maxsize=100_000)
def _person(name: str) -> tuple:
    return parse_name(name)


def surnames(authors: list[str]) -> list[str]:
    """A word that identifies each author, best first guess: before a comma, else the last one."""
    out = []
    for a in authors:
        org, words, _ = _person(a)
        if words:
            out.append(max(words, key=len) if org else words[0] if "," in a else words[-1])
    return out


def year_of(year: str | None) -> int | None:
    m = re.search(r"(?:1[89]|20)\d\d", year or "")
    return int(m.group()) if m else None


def attribute_keys(title: str | None, authors: list[str], year: str | None, paper: bool, every: bool = False) -> set[str]:
    """The blocking keys of a citation or paper.

    A citation uses surname and year (papers enter with the years around theirs too), bare
    surnames if it has no year, three neighbouring words of the title, two if it has no authors,
    and two neighbouring authors if it has no title. With ``every`` it uses all of these, as papers
    always do."""
    words = [w for w in title_tokens(title) if w not in STOP_WORDS]
    people, y = surnames(authors), year_of(year)
    spread = 1 if paper else 0
    keys = {f"y{p}|{v}" for p in people for v in (range(y - spread, y + spread + 1) if y else ())}
    every = every or paper
    if every or not y:
        keys |= {f"s{p}" for p in people}
    keys |= {f"t{a}|{b}|{c}" for a, b, c in zip(words, words[1:], words[2:])}
    if every or not people or len(words) < 3:
        keys |= {f"b{a}|{b}" for a, b in zip(words, words[1:])}
    if every or not words:
        keys |= {f"p{a}|{b}" for a, b in zip(people, people[1:])}
    return keys


def key_hash(key: str) -> int:
    return int.from_bytes(blake2b(key.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def _untitled(words: tuple[str, ...], authors: list[str], year: str | None, paper: bool) -> set[str]:
    """What a citation and a paper share that ``confidence`` can link though one of them has no title."""
    y = year_of(year)
    return {f"n{side}{y}|{len(authors)}" for side in "cp" if not words or side == ("c" if paper else "p")} if y and len(authors) > 1 else set()


def paper_tokens(title: str | None, authors: list[str], year: str | None) -> set[str]:
    """The second attributes of a paper: its title words, and what it shares with citations if one of them has no
    title; the empty token is for citations that refine nothing."""
    words = title_tokens(title)
    return {f"w{w}" for w in words} | _untitled(words, authors, year, True) | {""}


def citation_tokens(key: str, title: str | None, authors: list[str], year: str | None, common: dict[str, int]) -> set[str]:
    """The second attributes by which a citation divides a very frequent key: words of its title, and these joined
    with their neighbours.

    At most 0.3 of the words may lack a partner in a paper's title (``may_agree``), so one more than that,
    whichever they are, hold one that has a partner. The rarest are taken, without the words that the key
    itself names. If there are not enough words besides, the key is not divided."""
    words = title_tokens(title)
    out = _untitled(words, authors, year, False)
    if not words:
        return out
    places, need = list(range(len(words))), int(0.3 * len(words) + 1e-9) + 1
    for w in key[1:].split("|") if key[0] in "tb" else ():
        places.remove(next(k for k in places if words[k] == w))
    if len(places) < need:
        return {""}
    places.sort(key=lambda k: (max(common.get(f, 0) for f in _word_forms(words[k])), k))
    for k in places[:need]:
        out |= {f"w{words[k]}", *(f"j{a}{b}" for a, b in zip(words[max(0, k - 1) : k + 1], words[max(0, k - 1) + 1 : k + 2]))}
    return out


def probes(token: str, paper: bool) -> set[str]:
    """What the tokens of a citation and a paper share if one word may be the partner of the other."""
    kind, word = token[:1], token[1:]
    if kind != "w":
        return {f"f{word}"} if kind == "j" else set()
    return {f"f{f}" for f in _word_forms(word)} | ({f"a{word[:k]}" for k in range(3, len(word) + 1)} if paper else {f"a{word}"})


def _paper_tokens(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        rows = [(i, list(paper_tokens(t, list(a), y))) for i, t, a, y in zip(b["paper_no"], b["title"], b["people"], b["year"])]
        yield pd.DataFrame(rows, columns=["paper_no", "tokens"])


def _citation_tokens(every: bool, common: dict[str, int]) -> Callable:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for i, t, a, y, wide in zip(b["cid"], b["title"], b["people"], b["year"], b["wide"]):
                wide, a = set(wide), list(a)
                for k in attribute_keys(t, a, y, False, every):
                    if (h := key_hash(k)) in wide:
                        rows.append((h, i, list(citation_tokens(k, t, a, y, common))))
            yield pd.DataFrame(rows, columns=["key", "cid", "tokens"])

    return run


def _probes(paper: bool) -> Callable:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame([(t, p) for t in b["token"] for p in probes(t, paper)], columns=["token", "probe"])

    return run


def _word_match(r: str, q: str) -> bool:
    return r == q or (len(r) > 3 and len(q) > 3 and one_edit(r, q)) or (len(r) >= 3 and len(q) > len(r) + 1 and q.startswith(r))


@lru_cache(maxsize=65_536)
def _word_forms(word: str) -> frozenset[str]:
    return frozenset(_forms(word))


@lru_cache(maxsize=512)
def _reach(q: tuple[str, ...]) -> tuple[frozenset[str], frozenset[str]]:
    """All that can match a word of ``q``: forms of its words, and their beginnings."""
    return frozenset(f for w in q for f in _word_forms(w)), frozenset(w[:k] for w in q for k in range(3, len(w) + 1))


def may_agree(r: tuple[str, ...], q: tuple[str, ...]) -> bool:
    """False only if fewer than 0.7 of the words of ``r`` can have a partner in ``q``; much cheaper than
    ``title_agreement``, which decides."""
    forms, starts = _reach(q)
    miss, most = 0, 0.3 * len(r) + 1e-9
    for k, w in enumerate(r):
        if not (w in starts or w in forms or not forms.isdisjoint(_word_forms(w)) or k + 1 < len(r) and w + r[k + 1] in forms or k and r[k - 1] + w in forms):
            miss += 1
            if miss > most:
                return False
    return True


def title_agreement(r: tuple[str, ...], q: tuple[str, ...]) -> tuple[float, float]:
    """The parts of a citation's and of a paper's title words that have a partner in the other:
    equal, one letter off, or an abbreviation."""
    if not r or not q:
        return 0.0, 0.0
    left = list(q)
    hit, odd = 0, []
    for w in r:
        if w in left:
            left.remove(w)
            hit += 1
        else:
            odd.append(w)
    k = 0
    while k < len(odd):
        w = odd[k]
        m = next((v for v in left if _word_match(w, v)), None)
        if m is None and k + 1 < len(odd):  # a word torn in two
            m = next((v for v in left if v == w + odd[k + 1]), None)
            if m is not None:
                hit += 1
                k += 1
        if m is not None:
            left.remove(m)
            hit += 1
        k += 1
    return hit / len(r), (len(q) - len(left)) / len(q)


def author_agreement(r: list[str], q: list[str]) -> float | None:
    """The part of the shorter list that agrees in the longer; None if a list is empty."""
    if not r or not q:
        return None
    x, y = ([_person(a) for a in side] for side in (r, q))
    if len(x) > len(y):
        x, y = y, x
    left, hit = list(y), 0
    for a in x:
        m = next((b for b in left if a == b or same_name(a, b)), None)
        if m is not None:
            left.remove(m)
            hit += 1
    return hit / len(x)


def confidence(title: str | None, authors: list[str], year: str | None, p_title: str | None, p_authors: list[str], p_year: str | None) -> float:
    """How sure it is that a citation with the first three fields cites the paper with the others."""
    r, q = title_tokens(title), title_tokens(p_title)
    y, z = year_of(year), year_of(p_year)
    gap = abs(y - z) if y and z else None
    near = 0.0 if gap is None else 0.1 if gap == 0 else 0.03 if gap == 1 else -0.12
    if not r or not q:
        # authors and year alone: all of several people and the very year
        enough = gap == 0 and len(authors) >= 2 and len(authors) == len(p_authors)
        return 0.62 if enough and author_agreement(authors, p_authors) == 1.0 else 0.0
    if not may_agree(r, q):
        return 0.0
    cr, cq = title_agreement(r, q)
    cut = bool(re.search(r"(?:\.\.\.?|…)\W*$", title or ""))
    series_r, series_q = ({w for w in s if w in SERIES_WORDS} for s in (r, q))
    if cr < 0.7 or (cr < 0.8 and cq < 0.8) or sum(w not in STOP_WORDS for w in r) < 2 and cq < 0.6:
        return 0.0
    score = 0.35 * cr + 0.25 * cq + near
    if cut or cq < 0.75:
        score += 0.12 * (1 - cq)  # words cut off say little
    if series_r != series_q:
        score -= 0.25 if series_r - series_q or not (cut or cq < 0.7) else 0.1
    if score + 0.35 < BORDER:
        return 0.0  # whatever the authors are
    a = author_agreement(authors, p_authors)
    score += 0.15 if a is None else 0.35 * a if a >= 0.5 else -0.3
    return max(0.0, min(1.0, score))


def _keys(paper: bool, every: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(key_hash(k), i) for i, t, a, y in zip(b["id"], b["title"], b["people"], b["year"]) for k in attribute_keys(t, list(a), y, paper, every)]
            yield pd.DataFrame(rows, columns=["key", "id"])

    return run


def _score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compares citations with papers, people packed by ``SEP``; only what is to be kept is unpacked."""
    last, q = None, ()
    for b in batches:
        rows = []
        for cid, no, t, a, y, pt, p_people, py in zip(*(c.to_pylist() for c in b.columns)):
            if pt != last:  # rows come sorted by paper
                last, q = pt, title_tokens.__wrapped__(pt)
            r = title_tokens(t)
            if r and q and not may_agree(r, q):
                continue
            mine, theirs = ([x for x in s.split(SEP) if x] for s in (a, p_people))
            c = confidence(t, mine, y, pt, theirs, py)
            if c >= BORDER:
                rows.append((cid, no, c, sorted(set(surnames(mine)) & set(surnames(theirs)))))
        if rows:
            kinds = (pa.int64(), pa.int64(), pa.float64(), pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["cid", "paper_no", "confidence", "people"])


def attribute_rows(x: DataFrame, own: str, paper: bool, every: bool = False) -> DataFrame:
    """(key, ``own``): the hashed blocking keys of citations or papers."""
    rows = x.select(F.col(own).alias("id"), "title", "people", "year").mapInPandas(_keys(paper, every), "key long, id long")
    return stage(rows.select("key", F.col("id").alias(own)), "keys")


def refined_pairs(citations: DataFrame, papers: DataFrame, c: DataFrame, p: DataFrame, every: bool) -> DataFrame:
    """(key, cid, paper_no, worth): the pairs of the keys ``c`` and ``p``, all of them too frequent, that share a
    second attribute as well. Words are brought together once each, not once for every title."""
    held = stage(p, "wide")
    own = stage(papers.join(held.select("paper_no").distinct(), "paper_no", "left_semi").mapInPandas(_paper_tokens, "paper_no long, tokens array<string>"), "tokens")
    words = stage(own.select(F.explode("tokens").alias("token")).where("token like 'w%'").groupBy("token").agg(F.count(F.lit(1)).alias("n")), "words")
    common: dict[str, int] = {}
    for token, n in words.orderBy(F.desc("n"), "token").limit(COMMON_WORDS).collect():
        for f in _forms(token[1:]):
            common[f] = max(n, common.get(f, 0))
    some = citations.join(c.groupBy("cid").agg(F.collect_list("key").alias("wide")), "cid").select("cid", "title", "people", "year", "wide")
    wanted = stage(some.mapInPandas(_citation_tokens(every, common), "key long, cid long, tokens array<string>").select("key", "cid", F.explode("tokens").alias("token")), "wanted")
    offered = words.select("token").mapInPandas(_probes(True), "token string, probe string").withColumnRenamed("token", "word")
    asked = wanted.select("token").where("token like 'w%' or token like 'j%'").distinct().mapInPandas(_probes(False), "token string, probe string")
    partners = stage(asked.join(offered, "probe").select("token", "word").distinct(), "partners")
    fine = F.xxhash64("key", "word").alias("fine")
    left = wanted.join(partners, "token").unionByName(wanted.where("token = '' or token like 'n%'").withColumn("word", F.col("token"))).select(fine, "cid").distinct()
    rp = stage(held.join(own, "paper_no").select("key", "paper_no", F.explode("tokens").alias("word")).select("key", fine, "paper_no"), "refined")
    worth = rp.groupBy("fine").agg((F.lit(1.0) / F.count(F.lit(1))).alias("worth"))
    return left.join(rp.join(worth, "fine"), "fine").groupBy("key", "cid", "paper_no").agg(F.max("worth").alias("worth"))


def candidate_graph(citations: DataFrame, papers: DataFrame, p: DataFrame, every: bool = False) -> DataFrame:
    """(cid, paper_no, weight): pairs that share a key, weighted by the rarity of the keys they
    share, without the edges that are weak for their citation. With ``every``, citations use all
    keys and keep all edges. ``p`` holds the keys of the papers. Keys with too many pairs or papers are
    refined by a second attribute, and are worth what the rarest refined key is."""
    c = attribute_rows(citations, "cid", False, every)
    nc = c.groupBy("key").agg(F.count(F.lit(1)).alias("nc"))
    np_ = p.groupBy("key").agg(F.count(F.lit(1)).alias("np"))
    sizes = stage(nc.join(np_, "key").select("key", "np", (F.col("nc") * F.col("np")).alias("pairs")), "sizes")
    wide = (F.col("pairs") > MAX_KEY_PAIRS) | (F.col("np") > MAX_KEY_ROWS)
    fine = sizes.where(~wide).select("key", (F.lit(1.0) / F.col("np")).alias("worth"))
    pairs = p.join(fine, "key").join(c, "key").select("cid", "paper_no", "worth")
    wide = sizes.where(wide).select("key")
    if wide.limit(1).count():
        wide = small_side(wide)
        more = refined_pairs(citations, papers, c.join(wide, "key"), p.join(wide, "key"), every)
        pairs = pairs.unionByName(more.select("cid", "paper_no", "worth"))
    # one shuffle by citation serves both the sum and the pruning
    edges = pairs.repartition("cid").groupBy("cid", "paper_no").agg(F.sum("worth").alias("weight"))
    if every:
        return edges
    best = F.max("weight").over(Window.partitionBy("cid"))
    return edges.withColumn("best", best).where(F.col("weight") >= EDGE_SHARE * F.col("best")).select("cid", "paper_no", "weight")


def propagate(edges: DataFrame, works: DataFrame, cited_in: DataFrame, damping: float = 0.97, max_rounds: int = 20) -> DataFrame:
    """(cid, paper_no, first_no, confidence) after similarity has spread until nothing changes.

    ``edges`` has cid, paper_no, confidence and the people that both sides name, ``works`` (paper_no,
    first_no) the rows of each paper, ``cited_in`` (cid, doc) the documents of each citation. An edge of
    at least ``MIN_CONFIDENCE`` gives ``damping`` times its confidence to the other rows of its paper,
    which adds edges. One of at least ``BORDER`` gains up to ``LIFT``, by the part of its people of
    whom another paper is surely cited in one of the same documents. What is kept of a document and
    a person are the least and the greatest of these papers, whatever their number. Confidence only
    rises and is bounded, so the rounds end."""
    now = stage(edges.join(works, "paper_no").withColumn("base", F.col("confidence")), "edges")
    before = None
    for _ in range(max_rounds):
        sure = now.where(F.col("confidence") >= MIN_CONFIDENCE)
        state = tuple(now.agg(F.count(F.lit(1)), F.count_if(F.col("confidence") >= MIN_CONFIDENCE), F.round(F.sum("confidence"), 6)).first())
        if state == before:
            break
        before = state
        known = sure.select("cid", "first_no", F.explode("people").alias("who")).join(cited_in, "cid").groupBy("doc", "who").agg(F.min("first_no").alias("lo"), F.max("first_no").alias("hi"))
        open_ = now.where((F.col("base") < MIN_CONFIDENCE) & (F.size("people") > 0)).select("cid", "paper_no", "first_no", "base", F.size("people").alias("n"), F.explode("people").alias("who"))
        met = open_.join(cited_in, "cid").join(known, ["doc", "who"]).where("lo <> first_no or hi <> first_no")
        lifted = met.groupBy("cid", "paper_no").agg((F.count_distinct("who") / F.first("n") * LIFT).alias("gain"))
        now = now.join(lifted, ["cid", "paper_no"], "left").withColumn("confidence", F.greatest("confidence", F.col("base") + F.coalesce("gain", F.lit(0.0)))).drop("gain")
        top = sure.groupBy("cid", "first_no").agg((F.max("confidence") * damping).alias("confidence"))
        spread = top.join(works, "first_no").select("cid", "paper_no", "confidence", F.array().cast("array<string>").alias("people"), "first_no", F.lit(0.0).alias("base"))
        best = F.max(F.struct("base", "people")).alias("b")
        merged = now.select(*spread.columns).unionByName(spread).groupBy("cid", "paper_no", "first_no").agg(F.max("confidence").alias("confidence"), best)
        now = stage(merged.select("cid", "paper_no", "confidence", "b.people", "first_no", "b.base"), "edges")
    return now.where(F.col("confidence") >= MIN_CONFIDENCE).select("cid", "paper_no", "first_no", "confidence")


def link_citations(refs: DataFrame, papers: DataFrame, doc_sha: str = "doc_sha") -> DataFrame:
    """(ref_id, paper_no, confidence): for every citation the rows of the paper it cites.

    ``refs`` needs ref_id, title, authors (packed), year and, for what is cited together, if there
    is such a column, ``doc_sha``; ``papers`` paper_no, title, authors
    and year. Equal citations are compared once. If several papers come close, the best one
    wins; if the two best are equally good, the citation stays unlinked. NULL titles, authors or
    years simply say nothing; a citation with neither title nor authors, and one that agrees
    with no paper well enough, gives no row. Repeated rows of one ref_id count once; empty
    tables give an empty result; other columns are ignored."""
    people = split_packed(refs, "ref_id", "authors", "authors").groupBy("ref_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "item"))), lambda x: x["item"]).alias("people")
    )
    doc = F.col(doc_sha).alias("doc") if doc_sha in refs.columns else F.lit(None).cast("string").alias("doc")
    cited = refs.select("ref_id", "title", "year", doc).where("ref_id is not null").dropDuplicates(["ref_id"]).join(people, "ref_id", "left").withColumn(
        "people", F.coalesce("people", F.array().cast("array<string>"))
    )
    cited = stage(cited.withColumn("k", F.sha2(F.to_json(F.struct("title", "people", "year")), 256)), "cited")
    citations = stage(cited.groupBy("k").agg(F.min("ref_id").alias("cid"), F.first("title").alias("title"), F.first("people").alias("people"), F.first("year").alias("year")), "citations")
    rows = stage(papers.where("paper_no is not null").select("paper_no", "title", F.coalesce("authors", F.array().cast("array<string>")).alias("people"), "year"), "rows")
    keys = attribute_rows(rows, "paper_no", True)
    offers = rows.select("paper_no", F.col("title").alias("p_title"), F.array_join("people", SEP).alias("p_people"), F.col("year").alias("p_year"))

    def fitting(some: DataFrame, every: bool) -> DataFrame:
        edges = stage(candidate_graph(some, rows, keys, every), "graph")
        full = edges.join(some.withColumn("people", F.array_join("people", SEP)), "cid").join(offers, "paper_no").select("cid", "paper_no", "title", "people", "year", "p_title", "p_people", "p_year")
        return stage(full.mapInArrow(_score, "cid long, paper_no long, confidence double, people array<string>"), "fitting")

    plain = citations.drop("k")
    fit = fitting(plain, False)
    # dropped edges and keys must not cost a citation its paper
    found = fit.where(F.col("confidence") >= MIN_CONFIDENCE).select("cid").distinct()
    fit = fit.join(found, "cid", "left_semi").unionByName(fitting(stage(plain.join(found, "cid", "left_anti"), "left"), True))
    works = stage(group_papers(papers), "works")
    cited_in = stage(cited.join(citations.select("k", "cid"), "k").where("doc is not null").select("cid", "doc").distinct(), "citedin")
    strong = propagate(fit, works, cited_in)
    per_work = strong.groupBy("cid", "first_no").agg(F.max("confidence").alias("top"))
    w = Window.partitionBy("cid").orderBy(F.desc("top"), "first_no")
    ranked = per_work.withColumn("r", F.row_number().over(w)).withColumn("next", F.lead("top").over(w))
    chosen = ranked.where("r = 1 and (next is null or next < top - 1e-9)").select("cid", "first_no")
    linked = strong.join(chosen, ["cid", "first_no"]).select("cid", "paper_no", "confidence")
    return cited.select("ref_id", "k").join(citations.select("k", "cid"), "k").join(linked, "cid").select("ref_id", "paper_no", F.round("confidence", 6).alias("confidence"))
