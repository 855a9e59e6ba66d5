"""Problems 5 and 7 on small registries."""

import datetime as dt

import pytest

pytest.importorskip("citeloom.llm")

from citeloom.llm import linkage  # noqa: E402
from citeloom.llm.linkage import confidence, link_citations, title_tokens  # noqa: E402
from citeloom.llm.survivors import best_rows, group_papers, merged_documents, merged_records, precedence  # noqa: E402

PAPER = "paper_no long, doi string, arxiv string, title string, authors array<string>, documents array<string>, year string, feed string, updated_at timestamp, first_no int, field string"


def _papers(spark, rows):
    full = [(r.get("no"), r.get("doi"), r.get("arxiv"), r.get("title"), r.get("authors"), r.get("documents"), r.get("year"), r.get("feed"), r.get("at") and dt.datetime(2020, 1, r["at"]), 1, "x") for r in rows]
    return spark.createDataFrame(full, PAPER)


def test_best_rows(spark):
    rows = [
        dict(no=1, doi="10.5555/A", title="One fine paper", authors=["A. Leemann"], feed="f1", at=1, documents=["a", "a", "b"]), dict(no=2, doi="doi:10.5555/a.", arxiv="arXiv:2101.00001v2", authors=["Annabel Leemann"], feed="f2", at=2, documents=["b", "c"]),
        dict(no=3, arxiv="2101.00001", title="Paper: one FINE", feed="f2", at=3, authors=[]), dict(no=4, title="paper one fine!", authors=["Leemann, A."], feed="f1", at=5, documents=[]),
        dict(no=5, title="One fine paper", authors=["Bob Falkenau"], feed="f1", at=1), dict(no=6, doi="n/a", title="?", feed=None), dict(no=7, title=None, authors=None), dict(no=8, title="One fine paper", authors=[]),
        dict(no=10, doi="10.5555/t", feed="f1", at=1), dict(no=11, doi="10.5555/t", feed="f1", at=1), dict(no=12, doi="10.5555/T", feed="zz", at=9),
    ]
    p = _papers(spark, rows)
    feeds = spark.createDataFrame([("f1", 1), ("f2", 2)], "feed string, trust_rank int")
    groups = {r["paper_no"]: r["first_no"] for r in group_papers(p).collect()}
    assert groups == {1: 1, 2: 1, 3: 1, 4: 1, 5: 5, 6: 6, 7: 7, 8: 8, 10: 10, 11: 10, 12: 10}
    got = {(r["first_no"], r["field"]): r["from_no"] for r in best_rows(p, feeds).collect()}
    assert got == {(1, "doi"): 1, (1, "arxiv"): 3, (1, "authors"): 2, (10, "doi"): 10}
    assert {tuple(r) for r in merged_documents(p).collect()} == {(1, "a"), (1, "b"), (1, "c")}
    rec = {r["first_no"]: r for r in merged_records(p, feeds).collect()}
    assert rec[1]["doi"] == "10.5555/a" and rec[1]["authors"] == ["Annabel Leemann"] and rec[1]["n_documents"] == 3 and rec[10]["n_documents"] == 0
    assert best_rows(p.limit(0), feeds).count() == 0


def test_missing_time_stamps_use_learnt_order(spark):
    rows, n = [], 0
    for g in range(6):  # version 1 comes before version 2, authors by initials before written out
        for at, v, who in ((1, 1, "A. Leemann"), (2, 2, "Annabel Leemann")):
            n += 1
            rows.append(dict(no=n, doi=f"10.5555/g{g}", arxiv=f"2101.0000{g}v{v}", authors=[who], feed="f1", at=at))
    rows += [dict(no=90, doi="10.5555/q", arxiv="2102.00001v1", feed="f1", at=9), dict(no=91, arxiv="2102.00001v2", feed="f1"), dict(no=92, arxiv="2102.00001v1", feed="f1"), dict(no=93, arxiv="2102.00001v2", feed="f2", at=20)]
    rows += [dict(no=80, arxiv="2103.00001v2", feed="f1", at=9), dict(no=81, arxiv="2103.00001v1", feed="f1"), dict(no=82, arxiv="2103.00001v2", feed="f1")]  # a known time stamp is not overridden
    rows += [dict(no=70, arxiv="2104.00001v1", feed="f1"), dict(no=71, arxiv="2104.00001v2", feed="f1"), dict(no=72, arxiv="2104.00001v7", feed="zz")]
    feeds = spark.createDataFrame([("f1", 1), ("f2", 2)], "feed string, trust_rank int")
    got = {(r["first_no"], r["field"]): r["from_no"] for r in best_rows(_papers(spark, rows), feeds).collect()}
    assert got[90, "arxiv"] == 91 and got[1, "arxiv"] == 2 and got[80, "arxiv"] == 80 and got[70, "arxiv"] == 71


def test_precedence_has_no_cycles(spark):
    seen = [(1, "a", 1), (1, "b", 2), (2, "a", 1), (2, "b", 2), (3, "b", 1), (3, "c", 2), (4, "c", 1), (4, "a", 2), (5, "b", 1), (5, "a", 2)]
    times = spark.createDataFrame([(g, "doi", c, dt.datetime(2020, 1, t)) for g, c, t in seen], "first_no long, field string, cls string, t timestamp")
    order, level = precedence(times)
    assert order and all(level[f, a] < level[f, b] for f, a, b in order) and ("doi", "a", "b") in order or ("doi", "b", "c") in order


def test_linking(spark):
    papers = _papers(spark, [
        dict(no=1, title="Towards canopy weaving in lattice graphs: A study of cells", authors=["Annabel Leemann", "Bob Falkenau"], year="2001"),
        dict(no=2, title="Towards canopy weaving in lattice graphs: A study of cells. Part II", authors=["Annabel Leemann", "Bob Falkenau"], year="2004"),
        dict(no=3, title="Towards canopy weaving in lattice graphs: A study of cells", authors=["Cy Ottermole"], year="2011"),
        dict(no=4, title=None, authors=None, year=None), dict(no=5, title="Measuring drifting tensors by quantile probes", authors=["Dora Quistgaard"], year=None),
    ])
    refs = [
        (1, "Towards canopy weav- ing in lattice grpahs: A study of cells", "Leemann, A. and Falkenau, B.", "2001"), (2, "Towards canopy weaving in lattice graphs: Part II", "A. Leemann; B. Falkenau", "2004"),
        (3, "Towards canopy weaving in lattice...", "Ottermole, Cy", "2011"), (4, "Measuring drifting tensors by quantile probes", None, None), (5, "Something else entirely about birds", "Dora Quistgaard", "2001"),
        (6, None, None, None), (7, None, "Leemann, Annabel; Falkenau, Bob", "2001"), (8, "Towards canopy weaving in lattice graphs: A study of cells", "Zed Nobody", "2001"), (9, "", "", ""),
        (1, "Towards canopy weav- ing in lattice grpahs: A study of cells", "Leemann, A. and Falkenau, B.", "2001"),
    ]
    r = spark.createDataFrame([(*x, 5) for x in refs], "ref_id long, title string, authors string, year string, paper_no int")
    got = {(x["ref_id"], x["paper_no"]) for x in link_citations(r, papers).collect()}
    assert got == {(1, 1), (2, 2), (3, 3), (4, 5), (7, 1)}
    assert link_citations(r.limit(0), papers).count() == 0 and link_citations(r, papers.limit(0)).count() == 0


def test_citations_without_strong_edges_link(spark):
    title, authors = "Sampling brittle canopies under drifting tensors with quantile probes and lattice graphs", ["Annabel Leemann", "Bob Falkenau"]
    papers = _papers(spark, [dict(no=1, title=title, authors=authors, year=None), dict(no=2, title="Measuring stiff meadows", authors=["Dora Quistgaard"], year="2001")])
    damaged = "Sampling britle canopies drifting tensosr quantile probes latice graphs"
    r = spark.createDataFrame([(1, damaged, "A. Leemann; B. Falkenau", "2001")], "ref_id long, title string, authors string, year string")
    assert {(x["ref_id"], x["paper_no"]) for x in link_citations(r, papers).collect()} == {(1, 1)}


def test_refined_keys_lose_no_link(spark, monkeypatch):
    title, authors = "Sampling brittle canopies under drifting tensors", ["Annabel Leemann", "Bob Falkenau"]
    papers = _papers(spark, [dict(no=1, title=title, authors=authors, year="2001"), dict(no=2, title="Measuring stiff meadows", authors=["Dora Quistgaard", "Cy Ottermole"], year="2003")])
    refs = [(1, None, "Leemann, Annabel; Falkenau, Bob", "2001"), (2, "Samplng britttle canpoies undre driftin tensros", "A. Leemann; B. Falkenau", "2001"), (3, "Meas- uring stiff méadows", "Dora Quistgaard", "2003")]
    r = spark.createDataFrame(refs, "ref_id long, title string, authors string, year string")
    monkeypatch.setattr(linkage, "MAX_KEY_PAIRS", 0)  # every key is too wide
    assert {(x["ref_id"], x["paper_no"]) for x in link_citations(r, papers).collect()} == {(1, 1), (2, 1), (3, 2)}


def test_frequent_bigrams_do_not_pair_all(spark):
    syllables = ["bo", "cu", "di", "fa", "ge", "hi", "ko", "lu", "me", "ni"]
    words = [syllables[k // 10] * 2 + syllables[k % 10] * 2 for k in range(100)]
    rows = spark.createDataFrame([(k, f"Long range {w} {w[::-1]}", [], None) for k, w in enumerate(words)], "id long, title string, people array<string>, year string")
    papers, citations = rows.withColumnRenamed("id", "paper_no"), rows.withColumnRenamed("id", "cid")
    keys = linkage.attribute_rows(papers, "paper_no", True)
    edges = linkage.candidate_graph(citations, papers, keys, True).select("cid", "paper_no").collect()
    assert {(k, k) for k in range(100)} <= {tuple(e) for e in edges} and len(edges) < 200  # of 10,000


def test_scores():
    assert title_tokens("Los-\nt Cаnopies, 2nd") == ("lost", "canopies", "2nd")
    full = confidence("A canopy of cells", ["A. Leemann"], "2001", "A Canopy of Cells", ["Annabel Leemann"], "2001")
    assert full > confidence("A canopy of cells", ["A. Leemann"], None, "A Canopy of Cells", ["Annabel Leemann"], "2001") > 0.6
    assert confidence("A canopy of cells", ["A. Leemann"], "2001", "A Canopy of Cells", ["Bob Falkenau"], "2001") < 0.6
