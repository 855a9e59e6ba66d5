"""Identifiers, titles, names and dates."""

from pyspark.sql import functions as F

from citeloom.functions import ids, text


def _one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(f(F.col("v")).alias("x")).first()["x"]


def test_titles(spark):
    key = lambda s: _one(spark, s, text.normalize_title)
    assert key("Deep, “Learning”: A  Survey.") == key("deep learning a survey") == "deep learning a survey"
    assert key("State–of–the–Art & v1.5.") == "state-of-the-art & v1.5"
    assert key("ﬁne Straße") == "fine strasse"
    assert key(None) == ""


def test_dois(spark):
    doi = lambda s: _one(spark, s, ids.normalize_doi)
    assert doi("https://doi.org/10.5555/ABC.1).") == doi("DOI: 10.5555/abc.1") == "10.5555/abc.1"
    assert doi("none") is None and doi(None) is None
    assert _one(spark, "see 10.1234/X-y(2). Next", ids.extract_doi) == "10.1234/x-y(2"


def test_arxiv(spark):
    ax = lambda s, f=ids.normalize_arxiv: _one(spark, s, f)
    assert tuple(ax("arXiv:2101.00001V2")) == ("2101.00001", "v2")
    assert tuple(ax("hep-th/9901001")) == ("hep-th/9901001", None)
    assert ax("12.3") is None and ax(None) is None
    torn = "https://arxiv.org/abs/2101.\n00001v3"
    assert tuple(ax(torn, ids.extract_arxiv)) == ("2101.00001", "v3")
    assert ax(torn + " doi 10.5555/x", ids.citation_arxiv) is None
    assert tuple(ax("bare 2101.00001v2 id", ids.citation_arxiv)) == ("2101.00001", "v2")
    assert ax("2101. 00001", ids.extract_arxiv) is None
    assert _one(spark, "9912.0001", ids.arxiv_month) == "1999-12" and _one(spark, "2101.00001", ids.arxiv_month) == "2021-01"


def test_stamp_dates(spark):
    day = lambda s: _one(spark, s, ids.stamp_date)
    assert day("1 Jul 2022") == day(" 1 July 2022 ") == "2022-07-01"
    assert day("32 Jul 2022") is None and day("July 2022") is None and day(None) is None


def test_authors(spark):
    a = lambda s: _one(spark, s, text.normalize_author)
    assert tuple(a("Lee, Ann B.")) == ("lee", "ann", "a")
    assert tuple(a("Ann B. Lee Jr.")) == ("lee", "ann", "a")
    assert tuple(a("A. Müller†1")) == ("müller", "a", "a")
    assert a("Plato") is None and a("et al.") is None and a("and") is None and a(None) is None
    many = lambda s: [x["surname"] for x in _one(spark, s, text.parse_author_string)]
    assert many("Ann Lee; Bob Poe and Cy Roe") == ["lee", "poe", "roe"]
    assert many("Ann Lee, Bob Poe") == ["lee", "poe"] and many(None) == []
    assert [x["given"] for x in _one(spark, ["Ann Lee", None, "", "Poe, B."], text.parse_author_array, "array<string>")] == ["ann", "b"]


def test_compatibility(spark):
    def ok(a, b):
        df = spark.createDataFrame([(a, b)], "a array<string>, b array<string>")
        return df.select(text.authors_compatible(text.parse_author_array(F.col("a")), text.parse_author_array(F.col("b"))).alias("x")).first()["x"]

    assert ok(["J. Lee"], ["John Lee"]) and ok(["J. Lee"], ["Joseph Lee"]) and not ok(["John Lee"], ["Joseph Lee"])
    assert not ok([], []) and not ok(["J. Lee"], ["J. Lee", "A. Poe"]) and not ok(None, ["J. Lee"])


def test_paper_ids(spark):
    people = "array<struct<surname:string,given:string,initial:string>>"
    rows = [("10.5/x", "2101.1", "t", [], "f" * 64), ("10.5/x", None, "t", [], "f" * 64), (None, None, "t", [("lee", "ann", "a")], "f" * 64), (None, None, "", [], "f" * 64)]
    df = spark.createDataFrame(rows, f"doi string, arxiv string, title string, people {people}, sha string")
    got = [r[0] for r in df.select(ids.new_paper_id(*(F.col(c) for c in ("doi", "arxiv", "title", "people", "sha")))).collect()]
    assert got[0] == "arxiv:2101.1" and got[1] == "doi:10.5/x" and got[2].startswith("paper:") and got[3] == "paper:document:" + "f" * 16
    assert df.select(ids.stub_paper_id(F.col("doi"), F.col("arxiv"))).first()[0] == "doi:10.5/x"
