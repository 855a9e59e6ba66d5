"""Queries of the citation-graph operators with their SQL.

Parsers are checked on citations constructed from relational columns: Spark parses the text,
the SQL returns the columns it was made from. Relational operators run on the tables of the
corpus itself."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from citeloom.functions import ids, text
from citeloom.operators import bib, evidence, graph, identify, packed, reconcile, resolve, split, store
from citeloom.plans import pipeline
from citeloom.session import drop_at_exit, shared_dir, stage, table
from citeloom.sources import documents as src

Query = Callable[[SparkSession, str], DataFrame]


def _letters(c: Column) -> Column:
    """A word of letters for a number."""
    return F.translate(c.cast("string"), "0123456789", "abcdefghij")


_SQL_LETTERS = "translate(CAST({} AS VARCHAR), '0123456789', 'abcdefghij')"


# ---------------------------------------------------------------- sources (A)


def doc_sha_dedup(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select(F.sha2("text", 256).alias("sha256"), "doc_id")
    return src.first_of_each(docs, "sha256", "doc_id")


def known_documents(spark: SparkSession, d: str) -> DataFrame:
    return src.not_yet_known(table(spark, d, "documents").select("doc_id", "sha256"), table(spark, d, "manifest"))


def page_text(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("page_no", "text"))
    return src.assemble_text(lines, "doc_id").select("doc_id", F.sha2("text", 256).alias("sha256"))


def legacy_refs(spark: SparkSession, d: str) -> DataFrame:
    refs = table(spark, d, "refs")
    strings, objects = F.to_json(F.array("raw")), F.to_json(F.array(F.struct(F.lit(0).alias("index"), "raw")))
    entries = refs.select(F.col("ref_id").cast("string").alias("doc_sha"), F.lit("author").alias("mode"), F.lit(4).alias("splitter_version"), F.when(F.col("ref_id") % 2 == 0, strings).otherwise(objects).alias("refs_json"))
    return store.import_legacy_refs(entries).select("doc_sha", "index", "raw")


# ---------------------------------------------------------------- bibliography and splitting (B, C)


def bib_heading(spark: SparkSession, d: str) -> DataFrame:
    b = bib.bibliography(table(spark, d, "documents").select("doc_id", "text"))
    return b.select("doc_id", F.col("bib_heading").alias("heading"), F.col("bib_error").alias("error"))


def bib_section(spark: SparkSession, d: str) -> DataFrame:
    """The whole section with its stop, by document."""
    return bib.bibliography(table(spark, d, "documents").select("doc_id", "text")).select("doc_id", F.length("bib_text").alias("chars"), F.sha2("bib_text", 256).alias("sha256"))


def bib_sidecar(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("filename"), "text")
    return bib.sidecar(docs).select("filename", "status")


def bib_stops(spark: SparkSession, d: str) -> DataFrame:
    """Bibliographies made from orders, followed by one stop line of each kind in turn."""
    o = table(spark, d, "orders")
    stops = F.array(*[F.lit(s) for s in ("Appendix", "A. Overview of Parts\nSome text", "S SUPPLEMENT", "CONTENTS", "B Further results\n1 Setup")])
    body = F.concat(F.lit("Smith, J. Order "), _letters(F.col("o_orderkey")), F.lit(". 1999.\nJones, K. Another one. 2001."))
    made = F.concat(F.lit("Intro\nReferences\n"), body, F.lit("\n"), F.get(stops, (F.col("o_orderkey") % 5).cast("int")), F.lit("\nmore"))
    b = bib.bibliography(o.select("o_orderkey", made.alias("text")))
    return b.select("o_orderkey", F.regexp_replace("bib_text", r"^References\n|\n$", "").alias("body"))


#: Lines with a known answer; # stands for a word of its own.
HEAD_LINES = (
    ("Xa#. 2020. Thing", True), ("Group#. (2019) Thing", True), ("Org#. Title here", True), ("Two Org#. Title", True), ("Xa#, A., Poe, B.", True), ("Ann Xa# and Bob", True), ("A. Xa#. Title", True), ("A. B. Xa#, On", True),
    ("A Xa#. Title", True), ("Jean-Luc Xa#, On", True), ("In Proceedings of #", False), ("of the #", False), ("12 # pages", False), ("(2020) # y", False), ("abc", False), ("Proceedings. Of the #", False),
    ("Machine Learning Research #", False), ("Learn. Res. #", False), ("arXiv preprint #", False), ("URL Http#", False), ("X#", False), ("Xa# lower case", False), ("Computational Linguistics, #", False), ("The Xa#. 2020.", False),
)


def head_classify(spark: SparkSession, d: str) -> DataFrame:
    """Lines with a known answer made from orders, and whether each begins a citation."""
    lines = F.transform(F.array(*[F.lit(x) for x, _ in HEAD_LINES]), lambda x: F.replace(x, F.lit("#"), _letters(F.col("o_orderkey"))))
    made = table(spark, d, "orders").select("o_orderkey", F.posexplode(lines).alias("line_no", "line"))
    return made.select("o_orderkey", "line_no", split.is_head(F.col("line")).alias("head"))


def head_lines(spark: SparkSession, d: str) -> DataFrame:
    """Which lines of the citations of the corpus begin one."""
    lines = table(spark, d, "refs").select("ref_id", F.posexplode(F.split("raw", "\n")).alias("line_no", "line"))
    return lines.select("ref_id", "line_no", split.is_head(F.col("line")).alias("head"))


def split_bracket(spark: SparkSession, d: str) -> DataFrame:
    """Numbered bibliographies made from the lines of each supplier, read back entry by entry."""
    li = table(spark, d, "lineitem")
    entry = F.concat(F.lit("["), F.col("l_linenumber"), F.lit("] Xa"), _letters(F.col("l_partkey")), F.lit(", P. On part\n"), F.col("l_orderkey"), F.lit("."))
    docs = li.groupBy("l_suppkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("l_orderkey", "l_linenumber", "l_partkey", entry.alias("e")))), lambda v: v["e"]), "\n").alias("t"))
    s = split.split_bibliography(docs.select("l_suppkey", F.concat(F.lit("References\n"), "t").alias("bib_text")))
    return split.citation_rows(s, "l_suppkey", "mode")


def split_author(spark: SparkSession, d: str) -> DataFrame:
    """Author-year bibliographies made from orders and their lines, read back entry by entry."""
    li = table(spark, d, "lineitem")
    entry = F.concat(F.lit("Xa"), _letters(F.col("l_partkey")), F.lit(", P. On part "), _letters(F.col("l_partkey")), F.lit(".\nin two lines. Journal, "), (F.lit(1990) + F.col("l_linenumber")).cast("string"), F.lit("."))
    docs = li.groupBy("l_orderkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", entry.alias("e")))), lambda v: v["e"]), "\n").alias("t"))
    s = split.split_bibliography(docs.select("l_orderkey", F.concat(F.lit("References\n"), "t").alias("bib_text")))
    return split.citation_rows(s, "l_orderkey", "mode")


# ---------------------------------------------------------------- normalisers (D)


def norm_title(spark: SparkSession, d: str) -> DataFrame:
    made = F.concat(F.lit("“The "), F.upper("p_name"), F.lit("”:  "), "p_type", F.lit("; v1.5 – "), "p_brand", F.lit("."))
    return table(spark, d, "part").select("p_partkey", text.normalize_title(made).alias("title_norm"))


def title_keys(spark: SparkSession, d: str) -> DataFrame:
    """The title key of every paper and citation."""
    a = table(spark, d, "papers").select(F.concat(F.lit("p"), "paper_no").alias("row"), text.normalize_title(F.col("title")).alias("title_norm"))
    b = table(spark, d, "refs").select(F.concat(F.lit("r"), "ref_id").alias("row"), text.normalize_title(F.col("title")).alias("title_norm"))
    return a.unionByName(b)


def norm_doi(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "papers").select("paper_no", ids.normalize_doi(F.col("doi")).alias("doi"))


def norm_arxiv(spark: SparkSession, d: str) -> DataFrame:
    a = ids.normalize_arxiv(F.col("arxiv"))
    return table(spark, d, "papers").select("paper_no", a["base"].alias("base"), a["version"].alias("version"), ids.arxiv_month(a["base"]).alias("month"))


def citation_ids(spark: SparkSession, d: str) -> DataFrame:
    made = F.concat(
        F.lit("Smith, J. A title. "), F.when(F.col("l_linenumber") % 2 == 0, F.concat(F.lit("doi: 10.5555/ORD."), "l_orderkey", F.lit("."), "l_linenumber", F.lit(". "))).otherwise(""),
        F.when(F.col("l_linenumber") % 3 == 0, F.concat(F.lit("https://arxiv.org/abs/2101. "), F.lpad(F.col("l_linenumber").cast("string"), 5, "0"), F.lit("v2"))).otherwise(""), F.lit(" end"),
    )
    a = ids.citation_arxiv(made)
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", ids.extract_doi(made).alias("doi"), a["base"].alias("arxiv"), a["version"].alias("arxiv_version"))


def stamp_dates(spark: SparkSession, d: str) -> DataFrame:
    short = F.date_format("o_orderdate", "d MMM yyyy")
    long_ = F.date_format("o_orderdate", "d MMMM yyyy")
    return table(spark, d, "orders").select("o_orderkey", ids.stamp_date(F.when(F.col("o_orderkey") % 2 == 0, short).otherwise(F.concat(F.lit(" "), long_))).alias("day"))


def author_norm(spark: SparkSession, d: str) -> DataFrame:
    w = _letters(F.col("c_custkey"))
    made = F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("Xa"), w, F.lit(", Given M."))).when(F.col("c_custkey") % 3 == 1, F.concat(F.lit("Given Q. Xa"), w, F.lit(" Jr."))).otherwise(F.concat(F.lit("G. Xa"), w, F.lit("*3")))
    a = text.normalize_author(made)
    return table(spark, d, "customer").select("c_custkey", a["surname"].alias("surname"), a["given"].alias("given"), a["initial"].alias("initial"))


def author_lists(spark: SparkSession, d: str) -> DataFrame:
    w = _letters(F.col("s_suppkey"))
    made = F.concat(F.lit("Ann Xa"), w, F.when(F.col("s_suppkey") % 2 == 0, F.lit("; ")).otherwise(F.lit(" and ")), F.lit("B. Xb"), w)
    people = text.parse_author_string(made)
    return table(spark, d, "supplier").select("s_suppkey", text.authors_key(people).alias("authors_key"), text.full_given_names(people).cast("long").alias("full_names"))


def author_compat(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of neighbouring customers as authors that agree in surname: by full given name or by
    initial."""
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    given = F.when(F.col("c_custkey") % 2 == 0, F.lit("J. ")).otherwise(F.concat(F.lit("J"), _letters(F.col("c_nationkey")), F.lit(" ")))
    name = lambda k: F.array(F.concat(k, F.lit("Smith")))
    a = c.select("c_custkey", text.parse_author_array(name(given)).alias("a"))
    b = c.select((F.col("c_custkey") - 1).alias("c_custkey"), text.parse_author_array(name(given)).alias("b"))
    return a.join(b, "c_custkey").select("c_custkey", text.authors_compatible(F.col("a"), F.col("b")).alias("compatible"))


def paper_ids(spark: SparkSession, d: str) -> DataFrame:
    p = F.col("p_partkey")
    arxiv = F.when(p % 4 == 0, F.concat(F.lit("2101."), F.lpad(p.cast("string"), 5, "0")))
    doi = F.when(p % 2 == 0, F.concat(F.lit("10.5555/"), p))
    title = F.when(p % 3 != 0, F.lower("p_name"))
    none = F.array().cast("array<struct<surname:string,given:string,initial:string>>")
    return table(spark, d, "part").select("p_partkey", ids.new_paper_id(doi, arxiv, title, none, F.sha2(p.cast("string"), 256)).alias("id"))


# ---------------------------------------------------------------- front page (E)


def identify_documents(spark: SparkSession, d: str) -> DataFrame:
    """Identity evidence of every document, its text taken as the first page."""
    docs = table(spark, d, "documents").select("doc_id", F.col("text").alias("page1"), F.concat("doc_id", F.lit(".pdf")).alias("filename"), F.lit(None).cast("string").alias("meta_title"), F.lit(None).cast("string").alias("meta_author"))
    return identify.identify(docs).select("doc_id", "title", F.array_join("authors", "; ").alias("authors"), "arxiv", "doi", "year")


def identify_stamps(spark: SparkSession, d: str) -> DataFrame:
    """Front pages made from orders: stamp, title line, authors, and their reading."""
    o = table(spark, d, "orders")
    w = _letters(F.col("o_orderkey"))
    number = F.lpad((F.col("o_orderkey") % 100000).cast("string"), 5, "0")
    page = F.concat(F.lit("arXiv:2203."), number, F.lit("v3  [cs.LG]  "), F.date_format("o_orderdate", "d MMM yyyy"), F.lit("\nOn the order of "), w, F.lit(" things\nAnn Xa"), w, F.lit(", Bob Xb"), w, F.lit("\nAbstract\nText"))
    docs = o.select("o_orderkey", page.alias("page1"), F.lit("9999.00001.pdf").alias("filename"), F.lit("x").alias("meta_title"), F.lit(None).cast("string").alias("meta_author"))
    i = identify.identify(docs)
    return i.select("o_orderkey", "arxiv", "version", "arxiv_date", "arxiv_id_month", "arxiv_category", "title", F.array_join("authors", "; ").alias("authors"))


# ---------------------------------------------------------------- reconciliation (F)


def _evidence(spark: SparkSession, d: str) -> DataFrame:
    """Documents with evidence: those of papers that list them, in order of their ids."""
    docs = table(spark, d, "documents").select("doc_id", "sha256").dropDuplicates(["sha256"])
    p = table(spark, d, "papers").select("doi", "arxiv", "title", "authors", F.explode("documents").alias("sha256"))
    one = p.groupBy("sha256").agg(F.min(F.struct("title", "doi", "arxiv", "authors")).alias("p"))
    e = docs.join(one, "sha256")
    return e.select(
        "sha256", F.col("doc_id").alias("seq"), ids.normalize_doi(F.col("p.doi")).alias("doi"), ids.normalize_arxiv(F.col("p.arxiv"))["base"].alias("arxiv"),
        F.coalesce("p.title", F.lit("")).alias("title"), text.normalize_title(F.col("p.title")).alias("title_norm"), F.col("p.authors").alias("authors"), text.parse_author_array(F.col("p.authors")).alias("authors_norm"),
    )


def reconcile_all(spark: SparkSession, d: str) -> DataFrame:
    """Every listed document resolved against an empty registry, in order."""
    none = spark.createDataFrame([], reconcile.PAPER_JSON)
    done, _ = reconcile.reconcile_documents(none, _evidence(spark, d))
    return done


def reconcile_registry(spark: SparkSession, d: str) -> DataFrame:
    none = spark.createDataFrame([], reconcile.PAPER_JSON)
    _, papers = reconcile.reconcile_documents(none, _evidence(spark, d))
    return papers.select("id", "doi", "arxiv", "title_norm", F.size("documents").alias("n_documents"), F.array_join("reconciliation_conflict", " ").alias("conflict"))


def reconcile_strong(spark: SparkSession, d: str) -> DataFrame:
    """Documents made from line items, their DOI the part: one paper per part takes them all."""
    li = table(spark, d, "lineitem").select("l_partkey", F.sha2(F.concat_ws("/", "l_orderkey", "l_linenumber", "l_suppkey"), 256).alias("sha256"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"))
    e = li.select("sha256", "seq", F.concat(F.lit("10.5555/"), "l_partkey").alias("doi"), F.lit(None).cast("string").alias("arxiv"), F.lit("").alias("title"), F.lit("").alias("title_norm"),
                  F.array().cast("array<string>").alias("authors"), F.array().cast("array<struct<surname:string,given:string,initial:string>>").alias("authors_norm"))
    done, _ = reconcile.reconcile_documents(spark.createDataFrame([], reconcile.PAPER_JSON), e)
    return done.groupBy("paper_id").agg(F.count(F.lit(1)).alias("n_documents"), F.count_if(F.col("reconciliation") == "new").alias("n_new"))


# ---------------------------------------------------------------- evidence (G)


def _cited(spark: SparkSession, d: str, style: str) -> DataFrame:
    """Citations made from line items and parts."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    w, v, y = _letters(F.col("l_suppkey")), _letters(F.col("l_partkey")), (F.lit(1990) + F.col("l_linenumber")).cast("string")
    people = F.concat(F.lit("Xa"), w, F.lit(", J. and Xb"), w, F.lit(", K."))
    title = F.concat(F.lit("On the part "), v, F.lit(" of orders"))
    made = {
        "year": F.concat(people, F.lit(" "), y, F.lit(". "), title, F.lit(". Journal of Things 12, pages 1985-1989.")),
        "quoted": F.concat(people, F.lit(", “"), title, F.lit(",” Journal of Things, vol. 3, pp. 1-9, "), y, F.lit(". https://x.example/2004/a")),
        "stop": F.concat(F.lit("J. Xa"), w, F.lit(" and K. Xb"), w, F.lit(", et al. "), title, F.lit(". In Meeting on Things, "), y, F.lit(".")),
        "organisation": F.concat(F.lit("Institute of Xa"), w, F.lit(". "), y, F.lit(". "), title, F.lit(".")),
    }[style]
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", made.alias("raw"))


def _evidence_query(style: str) -> Query:
    def run(spark: SparkSession, d: str) -> DataFrame:
        e = evidence.parse_references(_cited(spark, d, style))
        return e.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "year", "title", "title_norm", text.authors_key(F.col("authors_norm")).alias("authors_key"), "authors_complete")

    run.__doc__ = f"Citations made in the style {style!r}, read back."
    return run


def _evidence_sql(style: str) -> str:
    w, v = _SQL_LETTERS.format("l_suppkey"), _SQL_LETTERS.format("l_partkey")
    people = f"'j:xa' || {w} || ':j|k:xb' || {w} || ':k'"
    keys, complete = {"organisation": ("NULL", "NULL"), "stop": (people, "false")}.get(style, (people, "true"))
    return f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(1990 + l_linenumber AS VARCHAR) AS year,
  'On the part ' || {v} || ' of orders' AS title, 'on the part ' || {v} || ' of orders' AS title_norm,
  CAST({keys} AS VARCHAR) AS authors_key, CAST({complete} AS BOOLEAN) AS authors_complete FROM lineitem"""


def citation_evidence(spark: SparkSession, d: str) -> DataFrame:
    """The evidence of every citation of the corpus."""
    e = evidence.parse_references(table(spark, d, "refs").select("ref_id", "raw"))
    return e.select("ref_id", "doi", "arxiv", "arxiv_version", "year", "title", text.authors_key(F.col("authors_norm")).alias("authors_key"), "authors_complete")


# ---------------------------------------------------------------- stores (H)


def _refs(spark: SparkSession, d: str) -> DataFrame:
    """Citations with structured authors, the order of their documents, one row per ref_id."""
    refs = table(spark, d, "refs")
    order = stage(refs.groupBy("doc_sha").agg(F.min("ref_id").alias("doc_seq")), "docseq")
    people = packed.split_packed(refs, "ref_id", "authors", "authors").groupBy("ref_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "item"))), lambda x: x["item"]).alias("_people"))
    return refs.join(order, "doc_sha").join(people, "ref_id", "left").withColumn("authors_norm", text.parse_author_array(F.col("_people"))).drop("_people")


def evidence_refresh(spark: SparkSession, d: str) -> DataFrame:
    """Stale citations read again; how many keep their resolution, by stored version."""
    refs = table(spark, d, "refs").withColumn("old_version", F.col("evidence_version")).withColumn("old_status", F.col("status"))
    refs = refs.withColumn("authors", F.array("authors")).withColumn("authors_norm", F.array().cast("array<struct<surname:string,given:string,initial:string>>"))
    return evidence.refresh_references(refs).select("ref_id", "old_version", "evidence_version", F.coalesce("old_status", F.lit("open")).alias("old_status"), F.coalesce("status", F.lit("open")).alias("status"))


def splitter_migrate(spark: SparkSession, d: str) -> DataFrame:
    """Stored splits of manifests' versions against a new split that joins every document's
    citations in order: nothing but the version may change."""
    refs = table(spark, d, "refs").where("doc_sha is not null")
    m = table(spark, d, "manifest").groupBy("doc_sha").agg(F.max("splitter_version").alias("splitter_version"), F.max("mode").alias("mode"))
    idx = F.row_number().over(Window.partitionBy("doc_sha").orderBy("ref_id")) - 1
    stored = refs.select("doc_sha", "ref_id", idx.alias("index"), "raw", "paper_id").join(m, "doc_sha")
    new = stored.groupBy("doc_sha").agg(F.transform(F.array_sort(F.collect_list(F.struct("index", "raw"))), lambda x: x["raw"]).alias("entries")).withColumn("mode", F.lit("author"))
    done = store.migrate_splits(stage(stored, "stored"), new)
    return done.groupBy("splitter_version").agg(F.count(F.lit(1)).alias("n_refs"), F.count("paper_id").alias("n_resolved"))


def backfill(spark: SparkSession, d: str) -> DataFrame:
    return store.to_backfill(table(spark, d, "manifest"), table(spark, d, "refs")).select("doc_sha", "filename")


def pending_documents(spark: SparkSession, d: str) -> DataFrame:
    return store.to_reconcile(table(spark, d, "manifest")).select("doc_sha", "filename")


# ---------------------------------------------------------------- resolution and graph (I, J, K)


def strong_matches(spark: SparkSession, d: str) -> DataFrame:
    return resolve.strong_matches(table(spark, d, "refs"), table(spark, d, "papers"), ["ref_id"])


def strong_current(spark: SparkSession, d: str) -> DataFrame:
    return resolve.current_strong(table(spark, d, "refs"), table(spark, d, "papers"), ["ref_id"])


def resolve_strong(spark: SparkSession, d: str) -> DataFrame:
    done, _ = resolve.resolve_strong(_refs(spark, d), table(spark, d, "papers"), table(spark, d, "manifest"))
    return done


def resolve_stubs(spark: SparkSession, d: str) -> DataFrame:
    """The papers after the strong pass that were not there before, or gained an identifier."""
    old = table(spark, d, "papers").select("id", "doi", "arxiv")
    _, papers = resolve.resolve_strong(_refs(spark, d), table(spark, d, "papers"), table(spark, d, "manifest"))
    return papers.select("id", "doi", "arxiv").exceptAll(old)


def resolve_constructed(spark: SparkSession, d: str) -> DataFrame:
    """Citations made from line items, every part a DOI, no paper yet: one stub per part."""
    li = table(spark, d, "lineitem")
    refs = li.select(
        F.concat_ws("/", "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey").alias("ref_id"), F.col("l_orderkey").cast("string").alias("doc_sha"), F.col("l_orderkey").alias("doc_seq"), F.col("l_linenumber").alias("ref_index"),
        F.concat(F.lit("https://doi.org/10.5555/P"), "l_partkey").alias("doi"), F.lit(None).cast("string").alias("arxiv"), F.lit("1999").alias("year"),
        *[F.lit(None).cast("string").alias(c) for c in ("paper_id", "status", "resolved_via")],
    )
    papers = spark.createDataFrame([("home", None, None, "", "", ["x"], None)], "id string, doi string, arxiv string, title string, title_norm string, documents array<string>, year string")
    manifest = refs.select("doc_sha").distinct().withColumn("paper_id", F.lit("home"))
    done, _ = resolve.resolve_strong(refs, papers, manifest)
    return done.groupBy("paper_id", "resolved_via").agg(F.count(F.lit(1)).alias("n"))


def anchor_resolve(spark: SparkSession, d: str) -> DataFrame:
    """The fallback pass over all citations without identifiers."""
    refs = stage(_refs(spark, d), "refs")
    return resolve.resolve_anchored(refs, table(spark, d, "papers"))


def anchor_constructed(spark: SparkSession, d: str) -> DataFrame:
    """Anchors made from parts, citations from line items: a citation is resolved if just one
    paper has its title and authors, ambiguous if several brands' papers do."""
    author = lambda g: F.array(F.struct(F.lit("smith").alias("surname"), g.alias("given"), F.lit("j").alias("initial")))
    p = table(spark, d, "part")
    anchors = p.select(F.concat(F.lit("doi:"), "p_partkey").alias("paper_id"), F.concat("p_brand", F.lit(" "), "p_type", F.lit(" "), "p_size").alias("title_norm"), author(F.lit("john")).alias("authors_norm"), F.lit(True).alias("authors_complete"))
    own = ["l_orderkey", "l_linenumber", "l_suppkey", "l_partkey"]
    # distinct after the join, whose partitions by part already hold equal rows together
    lines = table(spark, d, "lineitem").select(*own).join(p.select("p_partkey", "p_brand", "p_type", "p_size"), F.col("l_partkey") == F.col("p_partkey")).distinct()
    refs = lines.select(
        *own, F.concat("p_brand", F.lit(" "), "p_type", F.lit(" "), "p_size").alias("title_norm"),
        author(F.when(F.col("l_linenumber") % 2 == 0, F.lit("j")).when(F.col("l_linenumber") % 3 == 0, F.lit("joseph")).otherwise(F.lit("john"))).alias("authors_norm"), F.lit(True).alias("authors_complete"),
    )
    c = resolve.anchor_candidates(refs, anchors, own)
    return c.groupBy("n_candidates").agg(F.count(F.lit(1)).alias("n_refs"))


def edges_strong(spark: SparkSession, d: str) -> DataFrame:
    refs = table(spark, d, "refs").where(F.col("resolved_via").isin("doi", "arxiv"))
    blank = refs.withColumn("authors_norm", F.array().cast("array<struct<surname:string,given:string,initial:string>>"))
    return graph.build_edges(blank, table(spark, d, "papers"), table(spark, d, "manifest"))


def edges_all(spark: SparkSession, d: str) -> DataFrame:
    return graph.build_edges(stage(_refs(spark, d), "refs"), table(spark, d, "papers"), table(spark, d, "manifest"))


def prune_orphans(spark: SparkSession, d: str) -> DataFrame:
    return graph.prune_orphans(table(spark, d, "papers"), table(spark, d, "refs"), table(spark, d, "manifest")).select("paper_no", "id")


def run_metrics(spark: SparkSession, d: str) -> DataFrame:
    return graph.run_metrics(table(spark, d, "refs"), table(spark, d, "papers"), table(spark, d, "manifest"), table(spark, d, "edges").distinct())


def graph_diff(spark: SparkSession, d: str) -> DataFrame:
    """Stored edges against those that follow from valid resolutions by identifier."""
    return graph.edge_changes(table(spark, d, "edges"), edges_strong(spark, d))


# ---------------------------------------------------------------- the whole run


def _made_documents(spark: SparkSession, d: str) -> DataFrame:
    """A document per customer with orders: stamped front page, bibliography of the parts ordered."""
    cited = table(spark, d, "lineitem").join(table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).select(F.col("o_custkey").alias("c_custkey"), "l_partkey")
    v = _letters(F.col("l_partkey"))
    entry = F.concat(F.lit("Xa"), v, F.lit(", P. On part "), v, F.lit(". Journal, 1999. doi: 10.5555/P"), "l_partkey")
    bibs = cited.groupBy("c_custkey").agg(F.array_join(F.array_sort(F.collect_list(entry)), "\n").alias("b"))
    w, k = _letters(F.col("c_custkey")), F.col("c_custkey")
    number = F.concat(F.lit("22"), F.lpad((1 + (k / 100_000).cast("int")).cast("string"), 2, "0"), F.lit("."), F.lpad((k % 100_000).cast("string"), 5, "0"))
    page = F.concat(F.lit("arXiv:"), number, F.lit("v1 [cs.LG] 1 Jul 2022\nOn the wishes of "), w, F.lit(" and others\nAnn Xa"), w, F.lit(", Bob Xb"), w, F.lit("\nAbstract\nText"))
    none = F.lit(None).cast("string")
    made = table(spark, d, "customer").join(bibs, "c_custkey").select("c_custkey", "c_nationkey", page.alias("page1"), F.concat(page, F.lit("\nReferences\n"), "b").alias("text"))
    return made.select("c_custkey", "c_nationkey", F.sha2("text", 256).alias("sha256"), F.concat(F.lpad(k.cast("string"), 9, "0"), F.lit(".pdf")).alias("filename"), "text", "page1", none.alias("meta_title"), none.alias("meta_author"), none.alias("error"))


def _two_runs(spark: SparkSession, d: str) -> tuple[pipeline.Run, store.Store]:
    """A run over the documents of some nations, then one over all documents."""
    root = f"{shared_dir(spark)}/citeloom-run-{uuid.uuid4().hex}"
    drop_at_exit(spark, root)
    docs, stores = stage(_made_documents(spark, d), "made"), store.Store(spark, root)
    pipeline.ingest(spark, stores, docs.where("c_nationkey < 12").drop("c_custkey", "c_nationkey"))
    return pipeline.ingest(spark, stores, docs.drop("c_custkey", "c_nationkey")), stores


def run_log(spark: SparkSession, d: str) -> DataFrame:
    """What the second of two runs did with each document."""
    run, _ = _two_runs(spark, d)
    return run.log.select("filename", "action")


def run_edges(spark: SparkSession, d: str) -> DataFrame:
    """The edges after two runs."""
    return _two_runs(spark, d)[1].read("edges")


def run_totals(spark: SparkSession, d: str) -> DataFrame:
    """The metrics of the second of two runs."""
    return _two_runs(spark, d)[0].metrics


def corpus_run(spark: SparkSession, d: str) -> DataFrame:
    """A run over all documents of the corpus, what stands before the bibliography taken as first page: what
    became of each document."""
    root = f"{shared_dir(spark)}/citeloom-run-{uuid.uuid4().hex}"
    drop_at_exit(spark, root)
    none = F.lit(None).cast("string")
    docs = table(spark, d, "documents").select(F.sha2("text", 256).alias("sha256"), F.concat(F.lpad(F.col("doc_id").cast("string"), 12, "0"), F.lit(".pdf")).alias("filename"), "text", pipeline.front_of(F.col("text")).alias("page1"), none.alias("meta_title"), none.alias("meta_author"), none.alias("error"))
    return pipeline.ingest(spark, store.Store(spark, root), docs.where("text is not null")).log


_MADE = """
made AS (SELECT DISTINCT c_custkey, c_nationkey, l_partkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey),
lines AS (SELECT count(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey)
"""
_NORM = """
nr AS (SELECT *, regexp_extract(lower(doi), '\\b10\\.[0-9]{4,9}/[-._;()/:a-z0-9]+\\b') AS d0, regexp_extract(lower(arxiv), '([0-9]{4}\\.[0-9]{4,5}|[a-z][a-z0-9.-]+/[0-9]{7})') AS a0 FROM refs),
np AS (SELECT *, regexp_extract(lower(doi), '\\b10\\.[0-9]{4,9}/[-._;()/:a-z0-9]+\\b') AS d0, regexp_extract(lower(arxiv), '([0-9]{4}\\.[0-9]{4,5}|[a-z][a-z0-9.-]+/[0-9]{7})') AS a0 FROM papers),
hits AS (
  SELECT ref_id, id, min(rank) AS rank FROM (
    SELECT r.ref_id, p.id, 0 AS rank FROM nr r JOIN np p ON r.d0 = p.d0 WHERE r.d0 <> ''
    UNION ALL SELECT r.ref_id, p.id, 1 FROM nr r JOIN np p ON r.a0 = p.a0 WHERE r.a0 <> '') GROUP BY ALL),
valid AS (
  SELECT r.ref_id, r.doc_sha, r.paper_id FROM nr r
  JOIN (SELECT ref_id, min(id) AS id FROM hits GROUP BY 1 HAVING count(*) = 1) h ON h.ref_id = r.ref_id AND h.id = r.paper_id
  JOIN np p ON p.id = r.paper_id
  WHERE r.status = 'resolved' AND r.resolved_via IN ('doi', 'arxiv')
    AND NOT coalesce(r.d0 <> '' AND p.d0 <> '' AND r.d0 <> p.d0, false) AND NOT coalesce(r.a0 <> '' AND p.a0 <> '' AND r.a0 <> p.a0, false)),
strong_edges AS (
  SELECT DISTINCT m.paper_id AS from_id, v.paper_id AS to_id FROM valid v JOIN manifest m ON m.doc_sha = v.doc_sha
  WHERE m.paper_id IN (SELECT id FROM papers))
"""

def graph_queries() -> dict[str, Query]:
    out = {f.__name__: f for f in (
        doc_sha_dedup, known_documents, page_text, legacy_refs, bib_heading, bib_section, bib_sidecar, bib_stops, head_classify, head_lines, split_bracket, split_author,
        norm_title, title_keys, norm_doi, norm_arxiv, citation_ids, stamp_dates, author_norm, author_lists, author_compat, paper_ids, identify_documents, identify_stamps,
        reconcile_all, reconcile_registry, reconcile_strong, citation_evidence, evidence_refresh, splitter_migrate, backfill, pending_documents,
        strong_matches, strong_current, resolve_strong, resolve_stubs, resolve_constructed, anchor_resolve, anchor_constructed, edges_strong, edges_all, prune_orphans, run_metrics, graph_diff, run_log, run_edges, run_totals, corpus_run,
    )}
    return out | {f"evidence_{s}": _evidence_query(s) for s in ("year", "quoted", "stop", "organisation")}


def graph_sql() -> dict[str, str]:
    cust, supp = _SQL_LETTERS.format("c_custkey"), _SQL_LETTERS.format("s_suppkey")
    order = _SQL_LETTERS.format("o_orderkey")
    out = {
        "doc_sha_dedup": "SELECT sha256(text) AS sha256, min(doc_id) AS doc_id FROM documents WHERE text IS NOT NULL GROUP BY 1",
        "known_documents": "SELECT doc_id, sha256 FROM documents WHERE sha256 NOT IN (SELECT doc_sha FROM manifest WHERE paper_id IS NOT NULL AND doc_sha IS NOT NULL)",
        "page_text": "SELECT doc_id, sha256(text) AS sha256 FROM documents WHERE text IS NOT NULL",
        "legacy_refs": "SELECT CAST(ref_id AS VARCHAR) AS doc_sha, CAST(0 AS INTEGER) AS index, raw FROM refs",
        "bib_heading": """SELECT doc_id, nullif(regexp_extract(text, '(?im)^\\s*(References|Bibliography)\\s*:?\\s*$', 1), '') AS heading,
  CASE WHEN regexp_matches(text, '(?im)^\\s*(References|Bibliography)\\s*:?\\s*$') THEN NULL ELSE 'no_references' END AS error FROM documents""",
        "bib_stops": f"SELECT o_orderkey, 'Smith, J. Order ' || {order} || '. 1999.' || chr(10) || 'Jones, K. Another one. 2001.' AS body FROM orders",
        "bib_section": r"""WITH h AS (SELECT doc_id, CASE WHEN regexp_matches(text, '(?im)^\s*(References|Bibliography)\s*:?\s*$') THEN
    regexp_replace(regexp_extract(text, '(?ims)(^\s*(References|Bibliography)\s*:?\s*$.*)'), '^\s+', '') END AS t FROM documents),
l AS (SELECT doc_id, t, string_split(t, chr(10)) AS l FROM h),
s AS (SELECT doc_id, t, l, list_filter(range(1, len(l) + 1), lambda i: regexp_matches(l[i], '(?i)^[ \t•]*(?:[A-Z]\.\s*|[A-Z]\s+)?(?:Appendices|Supplementary Material|Supplemental Material|Appendix)\b')
  OR regexp_matches(l[i], '(?i)^[ \t•]*S[ \t]+SUPPLEMENT[ \t]*$') OR regexp_matches(l[i], '(?i)^[ \t]*CONTENTS[ \t]*$')
  OR (regexp_matches(l[i], '^[ \t•]*[A-L](?:\.\s+|\s+)[A-Z]') AND coalesce(regexp_matches(l[i + 1], '^[ \t•]*[A-Z0-9]'), false) AND NOT regexp_matches(l[i], '\b(?:19|20)[0-9]{2}\b')
    AND NOT regexp_matches(l[i], '\bIn[ \t]*$') AND NOT regexp_matches(l[i], '[.,:;][ \t]*$') AND NOT regexp_matches(l[i + 1], '(?i)\bproceedings\b')
    AND (NOT regexp_matches(regexp_replace(l[i], '^[ \t•]*[A-L]\.?[ \t]+', ''), '[.,:;]') OR NOT regexp_matches(regexp_replace(l[i], '^[ \t•]*[A-L]\.?[ \t]+', ''), '[a-z.]'))
    AND length(regexp_replace(l[i], '^[ \t•]*[A-L]\.?[ \t]+', '')) BETWEEN 4 AND 120)) AS stops FROM l),
b AS (SELECT doc_id, CASE WHEN len(stops) > 0 THEN array_to_string(l[1 : stops[1] - 1], chr(10)) || chr(10) ELSE t END AS b FROM s)
SELECT doc_id, CAST(length(b) AS INTEGER) AS chars, sha256(b) AS sha256 FROM b""",
        "head_classify": "SELECT o_orderkey, CAST(line_no AS INTEGER) AS line_no, head FROM orders, (VALUES " + ", ".join(f"({k}, {str(h).lower()})" for k, (_, h) in enumerate(HEAD_LINES)) + ") AS t(line_no, head)",
        "split_bracket": f"""SELECT l_suppkey, 'bracket' AS mode, CAST(row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey) - 1 AS INTEGER) AS index,
  'Xa' || {_SQL_LETTERS.format("l_partkey")} || ', P. On part' || chr(10) || l_orderkey || '.' AS raw FROM lineitem""",
        "split_author": f"""SELECT l_orderkey, 'author' AS mode, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) - 1 AS INTEGER) AS index,
  'Xa' || {_SQL_LETTERS.format("l_partkey")} || ', P. On part ' || {_SQL_LETTERS.format("l_partkey")} || '. in two lines. Journal, ' || (1990 + l_linenumber) || '.' AS raw FROM lineitem""",
        "norm_title": "SELECT p_partkey, 'the ' || lower(p_name) || ' ' || lower(p_type) || ' v1.5 - ' || lower(p_brand) AS title_norm FROM part",
        "norm_doi": "SELECT paper_no, nullif(regexp_extract(lower(doi), '\\b10\\.[0-9]{4,9}/[-._;()/:a-z0-9]+\\b'), '') AS doi FROM papers",
        "norm_arxiv": """WITH x AS (SELECT paper_no, nullif(regexp_extract(lower(arxiv), '([0-9]{4}\\.[0-9]{4,5}|[a-z][a-z0-9.-]+/[0-9]{7})(v[0-9]+)?', 1), '') AS base,
  nullif(regexp_extract(lower(arxiv), '([0-9]{4}\\.[0-9]{4,5}|[a-z][a-z0-9.-]+/[0-9]{7})(v[0-9]+)?', 2), '') AS version FROM papers)
SELECT paper_no, base, version, CASE WHEN base[3:4] BETWEEN '00' AND '99' AND base[5] = '.' THEN
  CASE WHEN CAST(base[1:2] AS INTEGER) < 80 THEN '20' ELSE '19' END || base[1:2] || '-' || base[3:4] END AS month FROM x""",
        "citation_ids": """SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 2 = 0 THEN '10.5555/ord.' || l_orderkey || '.' || l_linenumber END AS doi,
  CASE WHEN l_linenumber % 3 = 0 AND l_linenumber % 2 <> 0 THEN '2101.' || lpad(CAST(l_linenumber AS VARCHAR), 5, '0') END AS arxiv,
  CASE WHEN l_linenumber % 3 = 0 AND l_linenumber % 2 <> 0 THEN 'v2' END AS arxiv_version FROM lineitem""",
        "stamp_dates": "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders",
        "author_norm": f"SELECT c_custkey, 'xa' || {cust} AS surname, CASE WHEN c_custkey % 3 = 2 THEN 'g' ELSE 'given' END AS given, 'g' AS initial FROM customer",
        "author_lists": f"SELECT s_suppkey, 'a:xa' || {supp} || ':ann|b:xb' || {supp} || ':b' AS authors_key, CAST(1 AS BIGINT) AS full_names FROM supplier",
        "author_compat": """SELECT a.c_custkey, a.c_custkey % 2 <> b.c_custkey % 2 OR a.c_custkey % 2 = 0 OR a.c_nationkey = b.c_nationkey AS compatible
FROM customer a JOIN customer b ON b.c_custkey - 1 = a.c_custkey""",
        "paper_ids": """SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN 'arxiv:2101.' || lpad(CAST(p_partkey AS VARCHAR), greatest(5, 5), '0') WHEN p_partkey % 2 = 0 THEN 'doi:10.5555/' || p_partkey
  WHEN p_partkey % 3 <> 0 THEN 'paper:' || sha256(lower(p_name) || chr(0))[1:16] ELSE 'paper:document:' || sha256(CAST(p_partkey AS VARCHAR))[1:16] END AS id FROM part""",
        "identify_stamps": f"""SELECT o_orderkey, '2203.' || lpad(CAST(o_orderkey % 100000 AS VARCHAR), 5, '0') AS arxiv, 'v3' AS version, strftime(o_orderdate, '%Y-%m-%d') AS arxiv_date, '2022-03' AS arxiv_id_month,
  'cs.LG' AS arxiv_category, 'On the order of ' || {order} || ' things' AS title, 'Ann Xa' || {order} || '; Bob Xb' || {order} AS authors FROM orders""",
        "reconcile_strong": "SELECT 'doi:10.5555/' || l_partkey AS paper_id, count(*) AS n_documents, CAST(1 AS BIGINT) AS n_new FROM lineitem GROUP BY 1",
        "splitter_migrate": """WITH m AS (SELECT doc_sha, max(splitter_version) AS v FROM manifest GROUP BY 1)
SELECT CAST(greatest(coalesce(v, 0), 5) AS INTEGER) AS splitter_version, count(*) AS n_refs, count(paper_id) AS n_resolved FROM refs JOIN m USING (doc_sha) GROUP BY 1""",
        "backfill": "SELECT doc_sha, filename FROM manifest WHERE doc_sha NOT IN (SELECT doc_sha FROM refs WHERE doc_sha IS NOT NULL)",
        "pending_documents": "SELECT doc_sha, filename FROM manifest WHERE paper_id IS NULL",
        "strong_matches": f"WITH {_NORM} SELECT ref_id, id AS paper_id, CASE WHEN rank = 0 THEN 'doi' ELSE 'arxiv' END AS via FROM hits",
        "strong_current": f"WITH {_NORM} SELECT ref_id FROM valid",
        "resolve_constructed": "SELECT 'doi:10.5555/p' || l_partkey AS paper_id, 'doi' AS resolved_via, count(*) AS n FROM lineitem GROUP BY l_partkey",
        "anchor_constructed": """WITH r AS (SELECT DISTINCT l_orderkey, l_linenumber, l_suppkey, l_partkey FROM lineitem), t AS (SELECT p_brand, p_type, p_size, count(*) AS n FROM part GROUP BY ALL)
SELECT n AS n_candidates, count(*) AS n_refs FROM r JOIN part ON l_partkey = p_partkey JOIN t USING (p_brand, p_type, p_size) WHERE l_linenumber % 2 = 0 OR l_linenumber % 3 <> 0 GROUP BY n""",
        "edges_strong": f"WITH {_NORM} SELECT from_id, to_id FROM strong_edges",
        "prune_orphans": """SELECT paper_no, id FROM papers WHERE documents IS NULL OR len(documents) > 0 OR reconciliation_conflict IS NOT NULL
  OR id IN (SELECT paper_id FROM refs WHERE status = 'resolved' AND paper_id IS NOT NULL) OR id IN (SELECT paper_id FROM manifest WHERE paper_id IS NOT NULL)
  OR id IN (SELECT unnest(reconciliation_conflict) FROM papers)""",
        "run_metrics": """SELECT count(*) AS total_refs, count(*) FILTER (resolved_via = 'doi') AS doi_resolved, count(*) FILTER (resolved_via = 'arxiv') AS arxiv_resolved,
  count(*) FILTER (resolved_via = 'title_authors_anchor') AS title_authors_resolved, count(*) FILTER (resolved_via IS NULL OR resolved_via NOT IN ('doi', 'arxiv', 'title_authors_anchor')) AS unresolved,
  (SELECT count(DISTINCT doc_sha) FROM manifest) AS documents, (SELECT count(*) FROM papers) AS papers, (SELECT count(*) FROM (SELECT DISTINCT * FROM edges)) AS edges FROM refs""",
        "run_log": f"WITH {_MADE} SELECT DISTINCT lpad(CAST(c_custkey AS VARCHAR), 9, '0') || '.pdf' AS filename, CASE WHEN c_nationkey < 12 THEN 'skip' ELSE 'new' END AS action FROM made",
        "run_edges": f"""WITH {_MADE} SELECT 'arxiv:22' || lpad(CAST(1 + c_custkey // 100000 AS VARCHAR), 2, '0') || '.' || lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0') AS from_id,
  'doi:10.5555/p' || l_partkey AS to_id FROM made""",
        "run_totals": f"""WITH {_MADE} SELECT (SELECT n FROM lines) AS total_refs, (SELECT n FROM lines) AS doi_resolved, CAST(0 AS BIGINT) AS arxiv_resolved, CAST(0 AS BIGINT) AS title_authors_resolved, CAST(0 AS BIGINT) AS unresolved,
  count(DISTINCT c_custkey) AS documents, count(DISTINCT c_custkey) + count(DISTINCT l_partkey) AS papers, count(*) AS edges,
  CAST(0 AS BIGINT) AS fallback_unique, CAST(0 AS BIGINT) AS fallback_ambiguous, CAST(0 AS BIGINT) AS fallback_no_match, CAST(0 AS BIGINT) AS fallback_incomplete FROM made""",
        "graph_diff": f"""WITH {_NORM}, old AS (SELECT DISTINCT from_id, to_id FROM edges)
SELECT *, 'added' AS change FROM (SELECT * FROM strong_edges EXCEPT SELECT * FROM old) UNION ALL SELECT *, 'removed' FROM (SELECT * FROM old EXCEPT SELECT * FROM strong_edges)""",
    } | {f"evidence_{s}": _evidence_sql(s) for s in ("year", "quoted", "stop", "organisation")}
    out["bib_sidecar"] = out["bib_section"].rpartition("\nSELECT")[0] + """
SELECT CAST(doc_id AS VARCHAR) AS filename, CASE WHEN b IS NULL THEN 'FAIL ' || doc_id || ' | no References/Bibliography heading found'
  ELSE 'OK   ' || doc_id || ' | heading=' || regexp_extract(b, '^[A-Za-z]+') || ' | chars=' || length(b) || ' | out=' || doc_id || '.references.txt' END AS status FROM b"""
    return out
