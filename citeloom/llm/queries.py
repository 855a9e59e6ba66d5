"""Queries of the training-data problems and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeloom.llm.batches import batch_pairs, batch_papers, near_classes
from citeloom.llm.leakage import find_leaks
from citeloom.llm.linkage import link_citations
from citeloom.llm.lookalikes import consistent_texts
from citeloom.llm.mixing import mix_documents, mix_report, token_lengths
from citeloom.llm.names import entity_pairs, link_names
from citeloom.llm.spans import shared_shares, shared_spans
from citeloom.llm.survivors import best_rows, merged_documents, merged_records
from citeloom.llm.titles import collapse_titles, title_groups
from citeloom.operators.packed import split_packed
from citeloom.session import stage, table

Query = Callable[[SparkSession, str], DataFrame]


def _titled(spark: SparkSession, d: str) -> DataFrame:
    return (
        table(spark, d, "papers").select(F.lit("papers").alias("tbl"), F.col("paper_no").alias("row_key"), "title")
        .unionByName(table(spark, d, "refs").select(F.lit("refs").alias("tbl"), F.col("ref_id").alias("row_key"), "title"))
    )


def p1_titles(spark: SparkSession, d: str) -> DataFrame:
    """One row per distinct title of a table, with the number of rows that carried it."""
    g = title_groups(collapse_titles(_titled(spark, d), "tbl", "row_key", "title"))
    return g.select(F.col("scope").alias("tbl"), "first_key", F.col("canonical").alias("words"), "copies")


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    m = collapse_titles(_titled(spark, d), "tbl", "row_key", "title")
    return m.where("key <> first_key").select(F.col("scope").alias("tbl"), "first_key", F.col("key").alias("dup_key"))


_P1_WORDS = """
words AS (
  SELECT tbl, k, array_to_string(list_sort(regexp_extract_all(lower(title), '[\\p{L}\\p{N}]+')), ' ') AS words FROM (
    SELECT 'papers' AS tbl, paper_no AS k, title FROM papers UNION ALL SELECT 'refs', ref_id, title FROM refs)
  WHERE title IS NOT NULL),
groups AS (SELECT tbl, words, min(k) AS first_key, count(*) AS copies FROM words WHERE words <> '' GROUP BY ALL)
"""


def p2_forms(spark: SparkSession, d: str) -> DataFrame:
    """papers.title and refs.raw in one consistent form."""
    rows = (
        table(spark, d, "papers").select(F.lit("papers").alias("tbl"), F.col("paper_no").alias("row_key"), F.col("title").alias("text"))
        .unionByName(table(spark, d, "refs").select(F.lit("refs").alias("tbl"), F.col("ref_id").alias("row_key"), F.col("raw").alias("text")))
    )
    return consistent_texts(rows, "tbl", "row_key", "text").withColumnsRenamed({"scope": "tbl", "key": "row_key"})


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return p2_forms(spark, d).where("changed").select("tbl", "row_key")


def author_spellings(spark: SparkSession, d: str) -> DataFrame:
    """Every author of papers.authors and refs.authors as spelt."""
    listed = table(spark, d, "papers").select(F.explode("authors").alias("name")).select(F.trim("name").alias("name"))
    packed = split_packed(table(spark, d, "refs"), "ref_id", "authors", "authors").select(F.col("item").alias("name"))
    return listed.unionByName(packed)


def p3_entities(spark: SparkSession, d: str) -> DataFrame:
    """Every distinct spelling of an author with the least spelling of its class."""
    return link_names(author_spellings(spark, d))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return entity_pairs(p3_entities(spark, d))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return batch_pairs(table(spark, d, "documents"))


def p4_classes(spark: SparkSession, d: str) -> DataFrame:
    """Every document with its class of near-copies, over all batches."""
    return near_classes(table(spark, d, "documents"))


def p4_papers(spark: SparkSession, d: str) -> DataFrame:
    """The paper of every document that is like one of an earlier batch."""
    return batch_papers(table(spark, d, "documents"), table(spark, d, "papers"))


def p5_links(spark: SparkSession, d: str) -> DataFrame:
    """Citations without identifiers with the rows of the paper they cite and a confidence."""
    refs = table(spark, d, "refs").where("doi is null and arxiv is null and paper_id is null")
    return link_citations(refs, table(spark, d, "papers"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return p5_links(spark, d).select("ref_id", "paper_no")


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return best_rows(table(spark, d, "papers"), table(spark, d, "feeds"))


def p7_records(spark: SparkSession, d: str) -> DataFrame:
    """The surviving record of every group of two or more rows."""
    r = merged_records(table(spark, d, "papers"), table(spark, d, "feeds"))
    return r.withColumn("authors", F.array_join("authors", "; "))


def p7_documents(spark: SparkSession, d: str) -> DataFrame:
    """The documents of every surviving record, one per row."""
    return merged_documents(table(spark, d, "papers"))


def p8_leaks(spark: SparkSession, d: str) -> DataFrame:
    """Every stretch of at least 13 words of an item in a document, with its place in the text."""
    return find_leaks(table(spark, d, "documents"), table(spark, d, "eval_items"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return p8_leaks(spark, d).select("doc_id", "item_id").distinct()


def _lengths(spark: SparkSession, d: str) -> DataFrame:
    return stage(token_lengths(table(spark, d, "documents")), "lengths")


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    """Target and reached share of every source of the mix."""
    return mix_report(_lengths(spark, d), table(spark, d, "mix_targets"))


def p9_mix(spark: SparkSession, d: str) -> DataFrame:
    """The documents of the mix and how often each is used."""
    return mix_documents(_lengths(spark, d), table(spark, d, "mix_targets"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return p9_shares(spark, d).where("not reachable").select("source")


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return shared_spans(table(spark, d, "documents")).select("doc_id").distinct()


def p10_spans(spark: SparkSession, d: str) -> DataFrame:
    """The stretches of every document that stand in another one too."""
    return shared_spans(table(spark, d, "documents"))


def p10_shares(spark: SparkSession, d: str) -> DataFrame:
    """How much of every document stands elsewhere too."""
    return shared_shares(table(spark, d, "documents"))


_NEAR = """
w AS (SELECT doc_id, batch_no, text, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS w FROM documents WHERE batch_no IS NOT NULL),
texts AS (SELECT array_to_string(w, ' ') AS t, arg_min(doc_id, (batch_no, doc_id)) AS rep, any_value(w) AS w FROM w WHERE len(w) > 2 GROUP BY 1),
g AS (SELECT DISTINCT rep, array_to_string(w[i : i + 2], ' ') AS g FROM (SELECT rep, w, unnest(range(1, len(w) - 1)) AS i FROM texts)),
n AS (SELECT rep, count(*) AS n FROM g GROUP BY ALL),
shared AS (SELECT a.rep AS a, b.rep AS b, count(*) AS c FROM g a JOIN g b USING (g) WHERE a.rep <> b.rep GROUP BY ALL),
links AS (SELECT a, b FROM shared JOIN n x ON a = x.rep JOIN n y ON b = y.rep WHERE c * 2 >= x.n + y.n - c),
members AS (SELECT doc_id, batch_no, rep FROM w JOIN texts ON array_to_string(w.w, ' ') = t)
"""
_SPANS = """
d AS (SELECT doc_id, text, unnest(range(1, greatest(length(text) - 298, 1))) AS i FROM documents WHERE text IS NOT NULL AND length(text) >= 300),
h AS (SELECT doc_id, i, md5(substr(text, i, 300)) AS h FROM d),
often AS (SELECT h FROM h GROUP BY h HAVING count(DISTINCT doc_id) > 1),
hit AS (SELECT doc_id, i, i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS gap FROM h SEMI JOIN often USING (h)),
run AS (SELECT doc_id, i, count(*) FILTER (gap IS NULL OR gap > 300) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM hit),
spans AS (SELECT doc_id, min(i) - 1 AS first, max(i) + 299 AS last FROM run GROUP BY doc_id, run)
"""


def llm_queries() -> dict[str, Query]:
    return {
        "p1_found": p1_found, "p1_titles": p1_titles,
        "p2_found": p2_found, "p2_forms": p2_forms,
        "p3_found": p3_found, "p3_entities": p3_entities,
        "p4_found": p4_found, "p4_classes": p4_classes, "p4_papers": p4_papers,
        "p5_found": p5_found, "p5_links": p5_links,
        "p7_found": p7_found, "p7_records": p7_records, "p7_documents": p7_documents,
        "p8_found": p8_found, "p8_leaks": p8_leaks,
        "p9_found": p9_found, "p9_shares": p9_shares, "p9_mix": p9_mix,
        "p10_found": p10_found, "p10_spans": p10_spans, "p10_shares": p10_shares,
    }


def llm_sql() -> dict[str, str]:
    return {
        "p1_found": f"""WITH {_P1_WORDS}
SELECT tbl, first_key, k AS dup_key FROM words JOIN groups USING (tbl, words) WHERE k <> first_key""",
        "p1_titles": f"WITH {_P1_WORDS} SELECT tbl, first_key, words, copies FROM groups",
        "p4_found": """
WITH w AS (SELECT doc_id, batch_no, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS w FROM documents WHERE batch_no IS NOT NULL),
g AS (SELECT DISTINCT doc_id, batch_no, array_to_string(w[i : i + 2], ' ') AS g FROM (SELECT doc_id, batch_no, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY ALL),
shared AS (SELECT a.doc_id AS doc_a, b.doc_id AS doc_b, count(*) AS c FROM g a JOIN g b USING (g)
  WHERE a.doc_id < b.doc_id AND a.batch_no <> b.batch_no GROUP BY ALL)
SELECT doc_a, doc_b FROM shared JOIN n x ON doc_a = x.doc_id JOIN n y ON doc_b = y.doc_id WHERE c * 2 >= x.n + y.n - c""",
        "p4_classes": f"""WITH RECURSIVE {_NEAR},
reach AS (SELECT rep AS a, rep AS b FROM texts UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
class AS (SELECT a AS rep, min(b) AS class_id FROM reach GROUP BY a), degree AS (SELECT a AS rep, count(*) AS n FROM links GROUP BY a)
SELECT doc_id, class_id, coalesce(n, 0) AS n_links FROM members JOIN class USING (rep) LEFT JOIN degree USING (rep)""",
        "p4_papers": f"""WITH {_NEAR},
listed AS (SELECT sha256, min(id) AS listed_id FROM (SELECT id, unnest(documents) AS sha256 FROM papers) GROUP BY 1),
pairs AS (SELECT a, b FROM links UNION ALL SELECT rep, rep FROM texts),
old AS (SELECT x.doc_id, y.doc_id AS like_doc, y.batch_no FROM pairs JOIN members x ON x.rep = a JOIN members y ON y.rep = b WHERE y.batch_no < x.batch_no),
best AS (SELECT doc_id, arg_min(like_doc, (batch_no, like_doc)) AS like_doc FROM old GROUP BY 1)
SELECT best.doc_id, like_doc, coalesce(paper_id, listed_id) AS paper_id FROM best JOIN documents d ON d.doc_id = like_doc LEFT JOIN listed USING (sha256)""",
        "p10_found": f"WITH {_SPANS} SELECT DISTINCT doc_id FROM spans",
        "p10_spans": f"WITH {_SPANS} SELECT doc_id, first, last FROM spans",
        "p10_shares": f"""WITH {_SPANS} SELECT doc_id, length(text) AS n_chars, CAST(coalesce(s, 0) AS BIGINT) AS shared_chars, round(CASE WHEN length(text) > 0 THEN coalesce(s, 0) / length(text) ELSE 0 END, 6) AS share
FROM documents LEFT JOIN (SELECT doc_id, sum(last - first) AS s FROM spans GROUP BY 1) USING (doc_id) WHERE text IS NOT NULL""",
        "p8_leaks": """
WITH x AS (SELECT doc_id, regexp_extract_all(text, '[\\p{L}\\p{N}]+') AS w, regexp_extract_all(text, '[^\\p{L}\\p{N}]+') AS g, length(regexp_extract(text, '^[^\\p{L}\\p{N}]*')) AS pre FROM documents),
p AS (SELECT doc_id, k, w, length(w[k]) AS n, pre + coalesce(sum(length(w[k]) + coalesce(length(g[k + CASE WHEN pre > 0 THEN 1 ELSE 0 END]), 0)) OVER
  (PARTITION BY doc_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS first FROM (SELECT *, unnest(range(1, len(w) + 1)) AS k FROM x)),
dg AS (SELECT doc_id, k, lower(array_to_string(w[k : k + 12], ' ')) AS t FROM p WHERE k + 12 <= len(w)),
iw AS (SELECT item_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS w FROM eval_items),
ig AS (SELECT DISTINCT item_id, array_to_string(w[i : i + 12], ' ') AS t FROM (SELECT item_id, w, unnest(range(1, len(w) - 11)) AS i FROM iw)),
hit AS (SELECT doc_id, item_id, k, k - lag(k) OVER (PARTITION BY doc_id, item_id ORDER BY k) AS gap FROM dg JOIN ig USING (t)),
run AS (SELECT *, count(*) FILTER (gap IS NULL OR gap > 13) OVER (PARTITION BY doc_id, item_id ORDER BY k) AS run FROM hit),
spans AS (SELECT doc_id, item_id, min(k) AS a, max(k) + 12 AS b FROM run GROUP BY doc_id, item_id, run)
SELECT s.doc_id, item_id, CAST(b - a + 1 AS INTEGER) AS words, CAST(x.first AS BIGINT) AS first_char, CAST(y.first + y.n AS BIGINT) AS last_char
FROM spans s JOIN p x ON x.doc_id = s.doc_id AND x.k = a JOIN p y ON y.doc_id = s.doc_id AND y.k = b""",
        "p8_found": """
WITH dw AS (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS w FROM documents),
iw AS (SELECT item_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS w FROM eval_items),
dg AS (SELECT doc_id, array_to_string(w[i : i + 12], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM dw)),
ig AS (SELECT item_id, array_to_string(w[i : i + 12], ' ') AS g FROM (SELECT item_id, w, unnest(range(1, len(w) - 11)) AS i FROM iw))
SELECT DISTINCT doc_id, item_id FROM dg JOIN ig USING (g)""",
        "p9_found": """
WITH have AS (SELECT source, sum(length(text)) AS n FROM documents GROUP BY source),
total AS (SELECT sum(length(text)) AS n FROM documents)
SELECT m.source FROM mix_targets m LEFT JOIN have USING (source), total
WHERE coalesce(have.n, 0) * m.max_repeats < m.target_share * total.n""",
    }
