"""Front pages, reconciliation, resolution, graph, stores, components."""

import random

import pytest
from pyspark.sql import functions as F

from citeloom.operators import graph, identify, reconcile, resolve, store
from citeloom.operators.components import connected_components
from citeloom.operators.skew import hot_split_join
from citeloom.sources import documents as src

AUTHORS = "array<struct<surname:string,given:string,initial:string>>"


def _doc(spark, rows):
    return spark.createDataFrame(rows, f"sha256 string, seq long, doi string, arxiv string, title string, title_norm string, authors array<string>, authors_norm {AUTHORS}")


def _names(*given):
    return [("lee", g, g[0]) for g in given]


def _run(spark, rows, papers=None):
    reg = spark.createDataFrame(papers or [], reconcile.PAPER_JSON)
    done, after = reconcile.reconcile_documents(reg, _doc(spark, rows))
    return {r["sha256"]: (r["paper_id"], r["reconciliation"]) for r in done.collect()}, {r["id"]: r for r in after.collect()}


def test_reconcile_by_ids_and_by_title(spark):
    rows = [
        ("s1", 1, "10.1/a", None, "T", "t", ["John Lee"], _names("john")), ("s2", 2, "10.1/a", "2101.1", "T", "t", ["J. Lee"], _names("j")),
        ("s3", 3, None, "2101.1", "", "", [], []), ("s4", 4, None, None, "T", "t", ["J. Lee"], _names("j")), ("s5", 5, None, None, "T", "t", ["Joseph Lee"], _names("joseph")),
        ("s6", 6, "10.1/zz", None, "T", "t", ["John Lee"], _names("john")), ("s7", 7, None, None, "", "", [], []), ("s8", 8, None, None, "U", "u", [], []), ("s9", 9, None, None, "U", "u", [], []),
    ]
    got, papers = _run(spark, rows)
    assert got["s1"] == ("doi:10.1/a", "new") and got["s2"] == ("doi:10.1/a", "matched-doi") and got["s3"] == ("doi:10.1/a", "matched-arxiv")
    assert got["s4"] == ("doi:10.1/a", "matched-title-authors") and got["s5"][1] == "new" and got["s6"] == ("doi:10.1/zz", "new")
    assert got["s7"] == ("paper:document:s7", "new") and got["s8"][1] == "new" and got["s9"] == (got["s8"][0], "matched-title-authors")
    assert sorted(papers["doi:10.1/a"]["documents"]) == ["s1", "s2", "s3", "s4"] and papers["doi:10.1/a"]["arxiv"] == "2101.1"


def test_reconcile_conflicts_cascade(spark):
    rows = [("s1", 1, "10.1/a", None, "", "", [], []), ("s2", 2, None, "2101.1", "", "", [], []), ("s3", 3, "10.1/a", "2101.1", "", "", [], []), ("s4", 4, "10.1/a", None, "", "", [], [])]
    got, papers = _run(spark, rows)
    assert got["s3"] == ("paper:conflict:s3", "conflict") and papers["paper:conflict:s3"]["reconciliation_conflict"] == ["arxiv:2101.1", "doi:10.1/a"]
    assert got["s4"][1] == "conflict"  # the conflict paper matches later documents too


def test_blockwise_fold_is_the_sequential_fold(spark):
    rng = random.Random(7)
    rows = []
    for i in range(120):
        doi = f"10.1/{rng.randrange(12)}" if rng.random() < 0.4 else None
        ax = f"2101.{rng.randrange(12)}" if rng.random() < 0.4 else None
        t = rng.choice(["", "t1", "t2", "t3", "t4"])
        g = _names(*rng.choice([(), ("john",), ("j",), ("joseph",), ("ann",)]))
        rows.append((f"{i:04d}x", i, doi, ax, t, t, [x[1] for x in g], g))
    got, papers = _run(spark, rows)
    reg = reconcile.Registry([])
    keys = ("surname", "given", "initial")
    for s, _, doi, ax, t, tn, a, g in rows:
        e = reconcile.Paper(doi=doi, arxiv=ax, title=t, title_norm=tn, authors=a, authors_norm=[dict(zip(keys, x)) for x in g])
        assert reg.reconcile(e, s) == got[s]
    assert {k: sorted(p.documents) for k, p in reg.papers.items()} == {k: sorted(r["documents"]) for k, r in papers.items()}


def test_reconcile_empty(spark):
    assert _run(spark, []) == ({}, {})


PAPER = "id string, doi string, arxiv string, title string, title_norm string, documents array<string>, reconciliation_conflict array<string>, year string"
REF = f"ref_id long, doc_sha string, doc_seq long, ref_index int, doi string, arxiv string, year string, title_norm string, authors_norm {AUTHORS}, authors_complete boolean, paper_id string, status string, resolved_via string"


def _ref(i, doi=None, ax=None, doc="d", title=None, g=None, complete=None, paper=None, via=None, year=None):
    return (i, doc, 1, i, doi, ax, year, title, _names(*g) if g else None, complete, paper, "resolved" if paper else None, via)


def _strong(spark, refs, papers, manifest=(("d", "home"),)):
    p = spark.createDataFrame([("home", None, None, "", "", ["d"], None, None), *papers], PAPER)
    r = spark.createDataFrame(refs, REF)
    m = spark.createDataFrame(list(manifest), "doc_sha string, paper_id string")
    done, after = resolve.resolve_strong(r, p, m)
    return {x["ref_id"]: (x["paper_id"], x["resolved_via"]) for x in done.collect()}, {x["id"]: x for x in after.collect()}


def test_strong_resolution(spark):
    papers = [("pa", "10.5555/a", None, "", "", [], None, None), ("pb", None, "2101.00001", "", "", [], None, None)]
    got, after = _strong(spark, [
        _ref(1, "https://doi.org/10.5555/A"), _ref(2, "10.5555/a", "2101.00001"), _ref(3, "10.5555/new", "2102.00002", year="1999"), _ref(4, None, "arXiv:2102.00002v3"), _ref(5),
        _ref(6, "10.5555/a", "2109.00009"), _ref(7, "10.5555/a", "2110.00001"), _ref(8, "10.5555/x", doc="unknown"),
    ], papers)
    assert got[1] == ("pa", "doi") and 2 not in got and got[3] == ("doi:10.5555/new", "doi") and got[4] == ("doi:10.5555/new", "arxiv")
    assert 5 not in got and got[6] == ("pa", "doi") and 7 not in got and 8 not in got
    assert after["pa"]["arxiv"] == "2109.00009" and after["doi:10.5555/new"]["year"] == "1999" and after["doi:10.5555/new"]["documents"] == []


def test_strong_resolution_depends_on_order(spark):
    both, doi, ax = ("10.5555/q", "2101.00007"), ("10.5555/q", None), (None, "2101.00007")
    first, _ = _strong(spark, [_ref(1, *both), _ref(2, *doi), _ref(3, *ax)], [])
    assert {v[0] for v in first.values()} == {"doi:10.5555/q"} and len(first) == 3
    last, _ = _strong(spark, [_ref(1, *ax), _ref(2, *doi), _ref(3, *both)], [])
    assert 3 not in last and last[1][0] == "arxiv:2101.00007"


def test_anchors_edges_and_pruning(spark):
    papers = spark.createDataFrame([("home", None, None, "", "", ["d"], None, None), ("p1", "10.5555/a", None, "", "", [], None, None), ("p2", "10.5555/b", None, "", "", [], None, None),
                                    ("lost", "10.5555/c", None, "", "", [], None, None), ("cand", "10.5555/d", None, "", "", [], None, None), ("conf", None, None, "", "", [], ["cand"], None)], PAPER)
    refs = spark.createDataFrame([
        _ref(1, "10.5555/a", title="t", g=["john"], complete=True, paper="p1", via="doi"), _ref(2, "10.5555/b", title="t", g=["joseph"], complete=True, paper="p2", via="doi"),
        _ref(3, title="t", g=["john"], complete=True), _ref(4, title="t", g=["j"], complete=True), _ref(5, title="t", g=["john"], complete=False), _ref(6, title="z", g=["john"], complete=True),
        _ref(7, title="z", g=["john"], complete=True, paper="p1", via="title_authors_anchor"), _ref(8, "10.5555/b", paper="p1", via="doi"),
    ], REF)
    m = spark.createDataFrame([("d", "home"), ("e", None)], "doc_sha string, paper_id string")
    out = resolve.resolve_anchored(refs, papers)
    assert {r["ref_id"]: (r["outcome"], r["paper_id"]) for r in out.collect()} == {
        3: ("unique", "p1"), 4: ("ambiguous", None), 5: ("incomplete", None), 6: ("no_match", None), 7: ("no_match", None)}
    after = resolve.apply_anchored(refs, out)
    state = {r["ref_id"]: (r["status"], r["paper_id"], r["resolved_via"]) for r in after.collect()}
    assert state[3] == ("resolved", "p1", "title_authors_anchor") and state[7] == (None, None, None) and state[1][2] == "doi"
    edges = graph.build_edges(after, papers, m)
    assert {tuple(r) for r in edges.collect()} == {("home", "p1"), ("home", "p2")}  # the stale ref 8 adds none
    kept = {r["id"] for r in graph.prune_orphans(papers, after, m).collect()}
    assert kept == {"home", "p1", "p2", "cand", "conf"}
    row = graph.run_metrics(after, papers, m, edges).first()
    assert (row["total_refs"], row["doi_resolved"], row["title_authors_resolved"], row["unresolved"], row["edges"]) == (8, 3, 1, 4, 2)
    old = spark.createDataFrame([("home", "p1"), ("x", "y")], "source string, target string")
    assert {tuple(r) for r in graph.edge_changes(old, edges).collect()} == {("home", "p2", "added"), ("x", "y", "removed")}


def test_identify(spark):
    page = "arXiv:2203.05482v3  [cs.LG]  1 Jul 2022\nA study of many small things\nHorn University\nAnn Lee, Bob Poe\nAbstract\ndoi 10.5555/q.1 in 1999"
    rows = [("s1", "9901.00001.pdf", page, None, None), ("s2", "2101.00002v1.pdf", "Short\nNo id on this page at all", "Untitled - Microsoft Word", "Ann Lee"), ("s3", "x.pdf", None, None, None), ("s4", "y.pdf", "Seen in 1987 or so", "A usable title", " ")]
    got = {r["sha256"]: r for r in identify.identify(spark.createDataFrame(rows, "sha256 string, filename string, page1 string, meta_title string, meta_author string")).collect()}
    a = got["s1"]
    assert (a["arxiv"], a["version"], a["arxiv_date"], a["arxiv_id_month"], a["arxiv_category"]) == ("2203.05482", "v3", "2022-07-01", "2022-03", "cs.LG")
    assert a["title"] == "A study of many small things" and a["authors"] == ["Ann Lee", "Bob Poe"] and a["doi"] == "10.5555/q.1" and a["year"] is None
    assert got["s2"]["arxiv"] == "2101.00002" and got["s2"]["title"] == "No id on this page at all" and got["s2"]["authors_raw"] == "Ann Lee"
    assert got["s3"]["title"] == "x.pdf" and got["s3"]["authors"] == [] and got["s4"]["title"] == "A usable title" and got["s4"]["year"] == "1987"


def test_store_and_migrations(spark, tmp_path):
    s = store.Store(spark, f"file://{tmp_path}/store")
    a, b = spark.range(3).toDF("x"), spark.range(4).toDF("x")
    assert s.read("papers") is None and s.save({"papers": a, "refs": b}) == ["papers", "refs"]
    assert s.save({"papers": a, "refs": b}) == [] and s.save({"papers": b}) == ["papers"] and s.read("papers").count() == 4
    s.clear()
    assert s.read("papers") is None
    entries = spark.createDataFrame([("d1", "author", 4, '["a", "b"]'), ("d2", "author", 4, '[{"index": 0, "raw": "c", "z": 1}]'), ("d3", "fail", 4, "[]")], "doc_sha string, mode string, splitter_version int, refs_json string")
    assert sorted((r["doc_sha"], r["index"], r["raw"]) for r in store.import_legacy_refs(entries).collect()) == [("d1", 0, "a"), ("d1", 1, "b"), ("d2", 0, "c")]
    stored = spark.createDataFrame([("same", 4, "author", 0, "a", "p"), ("same", 4, "author", 1, "b", None), ("diff", 4, "author", 0, "a", "p"), ("done", 5, "author", 0, "a", "p"), ("gone", 3, "author", 0, "a", "p")],
                                   "doc_sha string, splitter_version int, mode string, index int, raw string, paper_id string")
    new = spark.createDataFrame([("same", "author", ["a", "b"]), ("diff", "bracket", ["a", "x"]), ("done", "author", ["zzz"])], "doc_sha string, mode string, entries array<string>")
    got = {(r["doc_sha"], r["index"]): (r["splitter_version"], r["raw"], r["paper_id"]) for r in store.migrate_splits(stored, new).collect()}
    assert got == {("same", 0): (5, "a", "p"), ("same", 1): (5, "b", None), ("diff", 0): (5, "a", None), ("diff", 1): (5, "x", None), ("done", 0): (5, "a", "p"), ("gone", 0): (3, "a", "p")}


def test_sources(spark, tmp_path):
    for name, data in (("b.pdf", b"one"), ("a.pdf", b"one"), ("c.pdf", b"two"), ("d.txt", b"x")):
        (tmp_path / name).write_bytes(data)
    files = src.pdf_files(spark, f"file://{tmp_path}")
    assert sorted(r["filename"] for r in src.first_of_each(files).collect()) == ["a.pdf", "c.pdf"]
    assert all(r["error"].startswith("pdf_read:") for r in src.extract_pages(files).collect())
    pages = spark.createDataFrame([("s", 1, "b"), ("s", 0, "a"), ("s", 2, None)], "sha256 string, page_no int, text string")
    assert src.assemble_text(pages).first()["text"] == "a\nb\n"
    known = spark.createDataFrame([("s", "p"), ("t", None)], "doc_sha string, paper_id string")
    docs = spark.createDataFrame([("s",), ("t",), ("u",)], "sha256 string")
    assert sorted(r[0] for r in src.not_yet_known(docs, known).collect()) == ["t", "u"]


def test_stream(spark, tmp_path):
    from citeloom.streaming.ingest import stream_texts

    seen = []
    spark.createDataFrame([("a", "x")], "filename string, text string").write.parquet(f"file://{tmp_path}/in")
    for _ in range(2):
        stream_texts(spark, f"file://{tmp_path}/in", f"file://{tmp_path}/cp", lambda df, n: seen.extend(r["filename"] for r in df.collect()))
    assert seen == ["a"]


@pytest.mark.parametrize("seed", range(3))
def test_components_against_union_find(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(35)] + [(i, i + 1) for i in range(100, 140)] + [(5, 5), (1, 1)]
    edges += [(None, 3), (4, None)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and b is not None:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    df = spark.createDataFrame(edges, "a long, b long")
    assert {r["node"]: r["component"] for r in connected_components(df).collect()} == {x: find(x) for x in list(root)}
    assert connected_components(df.limit(0)).count() == 0


def test_hot_split_join(spark):
    big = spark.createDataFrame([("hot", i) for i in range(600)] + [(f"k{i % 300}", i) for i in range(600)] + [(None, 0)], "k string, v int")
    groups = big.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("m"))
    got = hot_split_join(big, groups, "k", "n").groupBy("k").count().collect()
    want = big.where("k is not null").groupBy("k").count().collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))


def test_anchors_of_one_title_meet_each_way_of_writing_once(spark):
    """Citations named by several columns; 500 of one title and 40 papers are no 20,000 pairs."""
    refs = spark.createDataFrame([("a", i, "t", _names("john" if i % 2 else "j"), True) for i in range(500)], "doc string, ref int, title_norm string, authors_norm array<struct<surname:string,given:string,initial:string>>, authors_complete boolean")
    anchors = spark.createDataFrame([(f"p{i}", "t", _names("john" if i % 4 else "joseph"), True) for i in range(40)], "paper_id string, title_norm string, authors_norm array<struct<surname:string,given:string,initial:string>>, authors_complete boolean")
    got = {(r["doc"], r["ref"]): (r["n_candidates"], r["paper_id"]) for r in resolve.anchor_candidates(refs, anchors, ["doc", "ref"]).collect()}
    assert got == {("a", i): (30, "p1") if i % 2 else (40, "p0") for i in range(500)}


def test_a_repeated_key_with_other_evidence_has_one_row(spark):
    row = "ref_id int, title_norm string, authors_norm array<struct<surname:string,given:string,initial:string>>, authors_complete boolean"
    refs = spark.createDataFrame([(1, "t", _names("john"), True), (1, "u", _names("john"), True), (2, "t", _names("john"), True), (2, "t", _names("j"), True)], row)
    anchors = spark.createDataFrame([("p", "t", _names("john"), True), ("q", "u", _names("john"), True)], "paper_id string, title_norm string, authors_norm array<struct<surname:string,given:string,initial:string>>, authors_complete boolean")
    got = {r["ref_id"]: (r["n_candidates"], r["paper_id"]) for r in resolve.anchor_candidates(refs, anchors).collect()}
    assert got == {1: (2, "p"), 2: (1, "p")}


def test_components_are_folded_across_frames():
    import pandas as pd

    paper = lambda **k: reconcile._json({"title": "", "title_norm": "", "authors": [], "authors_norm": [], **k})
    lines = [("a", "paper", None, paper(id="p", doi="10.5555/a")), ("a", "document", "s1", paper(doi="10.5555/a")), ("a", "document", "s2", paper(doi="10.5555/a", arxiv="2101.00001")), ("b", "document", "s3", paper(doi="10.5555/b"))]
    frames = [pd.DataFrame(lines[k : k + 1], columns=["block", "kind", "sha", "payload"]) for k in range(4)]
    out = pd.concat(reconcile._fold_all(iter(frames)))
    done = out[out["kind"] == "document"]
    assert list(zip(done["sha"], done["paper_id"], done["status"])) == [("s1", "p", "matched-doi"), ("s2", "p", "matched-doi"), ("s3", "doi:10.5555/b", "new")]
    assert sorted(out[out["kind"] == "paper"]["paper_id"]) == ["doi:10.5555/b", "p"]


def test_works_that_no_paper_has_need_no_fold(spark, monkeypatch):
    def never(pdf):
        raise AssertionError("folded")

    refs = [_ref(1, "10.5555/n", year="1999"), _ref(2, "10.5555/n", "2101.00004", year="2000"), _ref(3, None, "2101.00005"), _ref(4, None, "2101.00005", paper="arxiv:2101.00005", via="arxiv"), _ref(5, "10.5555/n", paper="gone", via="doi")]
    want, before = _strong(spark, [*refs, _ref(6, None, "2101.00004", year="2001")], [])  # a citation that comes by the arXiv id only: folded
    monkeypatch.setattr(resolve, "_fold", never)
    got, after = _strong(spark, refs, [])
    assert got == {k: v for k, v in want.items() if k != 6} and want[6] == ("doi:10.5555/n", "arxiv")
    assert got[1] == got[2] == got[5] == ("doi:10.5555/n", "doi") and got[3] == got[4] == ("arxiv:2101.00005", "arxiv")
    assert {i: (p["doi"], p["arxiv"], p["year"]) for i, p in after.items()} == {i: (p["doi"], p["arxiv"], p["year"]) for i, p in before.items()}
    assert after["doi:10.5555/n"]["arxiv"] == "2101.00004" and after["doi:10.5555/n"]["year"] == "1999"
