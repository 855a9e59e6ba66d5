"""Problem 7: the best representative of each duplicate group.

Rows are grouped through identifiers and through title plus authors; every field of the
surviving record comes from the best row that has it. Which of two equally trusted rows is the
more recent is decided by currency reasoning. Known time stamps always count as they are. For
rows without one, transitions between values are learnt from the time-stamped rows: wherever one
class of values of a field (a version of an identifier, the fullness of an author list) was last
seen in a group before another, that is a vote for this order. In each group the classes seen
there form a partial order, and a row without a time stamp is placed topologically: at the last
time its own class was seen, or else just after the last of the classes that come before it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeloom.llm.names import link_names
from citeloom.llm.titles import canonical_title
from citeloom.operators.components import connected_components
from citeloom.operators.skew import hot_split_join
from citeloom.session import small_side, stage

_DOI = r"10\.\d{4,9}/[^\s\"<>]+"
_ARXIV = r"(\d{4}\.\d{4,5}|[a-z][a-z.-]+/\d{7})(?:v\d+)?"
#: Rank of a row whose feed is unknown: after all known ones.
NO_RANK = 1_000_000


def doi_key(c: Column) -> Column:
    """The DOI in lower case without prefix or closing punctuation; NULL if there is none."""
    return F.nullif(F.regexp_replace(F.regexp_extract(F.lower(c), _DOI, 0), r"[.,;:)\]}]+$", ""), F.lit(""))


def arxiv_key(c: Column) -> Column:
    """The arXiv id without prefix or version; NULL if there is none."""
    return F.nullif(F.regexp_extract(F.lower(c), _ARXIV, 1), F.lit(""))


def written_given_names(authors: Column) -> Column:
    """How many of the author strings have a given name of more than an initial.

    "Surname, Given" and "Given Surname" are understood; bare capitals ("Surname HT") and
    dotted letters are initials."""

    def one(a: Column) -> Column:
        given = F.when(a.contains(","), F.regexp_extract(a, r",(.*)$", 1)).otherwise(F.regexp_replace(a, r"(?U)(?:^|\s+)(?:\p{Ll}[\p{L}'’-]*\s+)*[\p{L}'’-]{2,}\s*$", ""))
        given = F.when(a.rlike(r"(?U)^\s*[\p{L}'’ -]+\s\p{Lu}{1,3}\s*$"), F.lit("")).otherwise(given)
        return given.rlike(r"(?U)\p{L}[\p{L}'’-]+")

    return F.size(F.filter(F.coalesce(authors, F.array()), one))


def group_papers(papers: DataFrame) -> DataFrame:
    """(paper_no, first_no): rows of the same paper with the smallest number among them.

    Rows belong together by DOI, by arXiv id apart from its version, or by the words of the
    title and the same persons as authors in the same order, also through other rows. Rows
    without any of these stand alone; empty author lists and wordless titles link nothing."""
    p = papers.select("paper_no", doi_key(F.col("doi")).alias("doi"), arxiv_key(F.col("arxiv")).alias("arxiv"), canonical_title(F.col("title")).alias("words"), "authors").where("paper_no is not null")
    # authors decide only between rows whose titles have the same words
    alike = stage(p.where("words is not null").groupBy("words").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "alike")
    titled = stage(hot_split_join(p.select("paper_no", "words", "authors"), alike, "words", "n").drop("n"), "titled")
    written = titled.select("paper_no", F.posexplode("authors").alias("pos", "name")).withColumn("name", F.trim("name")).where("name <> ''")
    entity = link_names(written)
    persons = (
        written.join(entity, "name").groupBy("paper_no")
        .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "entity"))), lambda x: x["entity"]), "\u0002").alias("persons"))
    )
    keys = (
        p.where("doi is not null").select("paper_no", F.concat(F.lit("d:"), "doi").alias("g"))
        .unionByName(p.where("arxiv is not null").select("paper_no", F.concat(F.lit("a:"), "arxiv").alias("g")))
        .unionByName(titled.join(persons, "paper_no").select("paper_no", F.concat(F.lit("t:"), "words", F.lit("\u0001"), "persons").alias("g")))
    )
    keys = stage(keys, "keys")
    first = stage(keys.groupBy("g").agg(F.min("paper_no").alias("b"), F.count(F.lit(1)).alias("n")).where("n > 1"), "first")
    edges = hot_split_join(keys, first, "g", "n").select(F.col("paper_no").alias("a"), "b").where("a <> b")
    comp = connected_components(edges)
    return p.select("paper_no").distinct().join(comp, F.col("paper_no") == F.col("node"), "left").select("paper_no", F.coalesce("component", "paper_no").alias("first_no"))


FIELDS = ("doi", "arxiv", "authors")


def value_classes(rows: DataFrame) -> DataFrame:
    """(first_no, paper_no, field, cls, merit, has, trust_rank, updated_at): one row per row and field.
    ``cls`` is the class of the value, of which a field has at most 121, ``merit`` what counts before trust."""
    fewest = lambda c: F.least(c, F.lit(9)).cast("string")
    doi = F.lower(F.trim("doi"))
    kinds = {
        "doi": (F.when(F.col("doi_value").isNull(), "none").when(doi.startswith("http"), "link").when(doi.startswith("doi"), "marked").otherwise("bare"), F.lit(0), F.col("doi_value").isNotNull()),
        "arxiv": (F.when(F.col("arxiv_value").isNull(), "none").otherwise(F.concat(F.lit("v"), F.right(F.regexp_extract(F.lower("arxiv"), r"v(\d+)\s*$", 1), F.lit(1)))), F.lit(0), F.col("arxiv_value").isNotNull()),
        "authors": (F.concat_ws("/", fewest(F.col("written")), fewest(F.coalesce(F.size("authors"), F.lit(0)))), F.col("written"), F.coalesce(F.size("authors") > 0, F.lit(False))),
    }
    long = F.array(*[F.struct(F.lit(f).alias("field"), c.alias("cls"), m.alias("merit"), h.alias("has")) for f, (c, m, h) in kinds.items()])
    return rows.select("first_no", "paper_no", "trust_rank", "updated_at", F.inline(long))


def class_times(values: DataFrame) -> DataFrame:
    """(first_no, field, cls, t): when each class of values was last seen in each group."""
    return values.where("updated_at is not null").groupBy("first_no", "field", "cls").agg(F.max("updated_at").alias("t"))


def precedence(times: DataFrame) -> tuple[dict[tuple[str, str, str], bool], dict[tuple[str, str], int]]:
    """(order, level): ``order[field, a, b]`` where class a comes before class b of a field, and the
    topological level of every class.

    Every group votes once for each pair of classes it has seen; the majority decides. Where the
    majorities form a cycle, the class with the least incoming surplus goes first and the edges
    against it are dropped, so that every group's order is acyclic. The votes are counted over
    all groups; the classes are few, so what reaches the driver is bounded."""
    seen = times.groupBy("first_no", "field").agg(F.collect_list(F.struct("cls", "t")).alias("s")).where(F.size("s") > 1)
    pairs = seen.select("field", F.explode("s").alias("x"), "s").select("field", "x", F.explode("s").alias("y")).where("x.t < y.t")
    votes = {(r["field"], r["a"], r["b"]): r["n"] for r in pairs.groupBy("field", F.col("x.cls").alias("a"), F.col("y.cls").alias("b")).agg(F.count(F.lit(1)).alias("n")).collect()}
    surplus = {k: n - votes.get((k[0], k[2], k[1]), 0) for k, n in votes.items()}
    level: dict[tuple[str, str], int] = {}
    for field in FIELDS:
        todo, n = {c for f, a, b in votes if f == field for c in (a, b)}, 0
        while todo:
            into = {c: sum(max(0, surplus.get((field, o, c), 0)) for o in todo) for c in todo}
            now = {c for c in todo if not into[c]} or {min(todo, key=lambda c: (into[c], c))}
            level.update({(field, c): n for c in now})
            todo -= now
            n += 1
    order = {(f, a, b): True for (f, a, b), n in surplus.items() if n > 0 and level[f, a] < level[f, b]}
    return order, level


def placed(values: DataFrame) -> DataFrame:
    """``values`` with ``t`` and ``depth``, which say how recent each row is. A row with a time stamp has that
    and 0; one without has the time its class was last seen in the group and -1, or the last time of
    the classes before its own and its level, or no time and its level."""
    times = stage(class_times(values), "times")
    order, level = precedence(times)
    spark = values.sparkSession
    levels = spark.createDataFrame([(f, c, n) for (f, c), n in level.items()], "field string, cls string, level int")
    edges = spark.createDataFrame([(*k, level[k[0], k[2]]) for k in order], "field string, before string, cls string, depth int")
    own = levels.select("field", F.col("cls").alias("before"), "cls", F.lit(-1).alias("depth"))
    alone = times.select("field", "cls").distinct().join(F.broadcast(levels), ["field", "cls"], "left_anti").select("field", F.col("cls").alias("before"), "cls", F.lit(-1).alias("depth"))
    edges = F.broadcast(edges.unionByName(own).unionByName(alone))  # at most the squares of the classes
    untimed = values.where("updated_at is null")
    asked = untimed.select("first_no", "field", "cls").distinct()
    guess = (
        asked.join(edges, ["field", "cls"]).join(times.withColumnRenamed("cls", "before"), ["first_no", "field", "before"])
        .groupBy("first_no", "field", "cls").agg(F.max(F.struct("t", "depth")).alias("at"))
    )
    found = untimed.join(guess, ["first_no", "field", "cls"], "left").join(F.broadcast(levels), ["field", "cls"], "left")
    found = found.select(*values.columns, F.col("at.t").alias("t"), F.coalesce("at.depth", "level", F.lit(0)).alias("depth"))
    return values.where("updated_at is not null").select("*", F.col("updated_at").alias("t"), F.lit(0).alias("depth")).unionByName(found)


def _grouped(papers: DataFrame, feeds: DataFrame, groups: DataFrame) -> DataFrame:
    """The rows of groups of two or more, with group, rank and keys; staged."""
    rank = feeds.where("feed is not null").groupBy("feed").agg(F.min("trust_rank").alias("trust_rank"))
    rows = papers.select("paper_no", "doi", "arxiv", "authors", "feed", "updated_at").where("paper_no is not null").join(groups, "paper_no")
    rows = rows.join(small_side(rank), "feed", "left").withColumn("trust_rank", F.coalesce("trust_rank", F.lit(NO_RANK)))
    sizes = stage(groups.groupBy("first_no").agg(F.count(F.lit(1)).alias("group_rows")).where("group_rows > 1"), "groupsizes")
    rows = hot_split_join(rows, sizes, "first_no", "group_rows")
    return stage(
        rows.withColumn("doi_value", doi_key(F.col("doi"))).withColumn("arxiv_value", arxiv_key(F.col("arxiv"))).withColumn("written", written_given_names(F.col("authors"))), "grouped"
    )


def best_rows(papers: DataFrame, feeds: DataFrame, groups: DataFrame | None = None) -> DataFrame:
    """(first_no, field, from_no): for every group of two or more rows, the row that each of the
    fields doi, arxiv and authors is taken from.

    doi and arxiv: of the rows with a value the least trust_rank, then the most recent (see
    ``placed``). authors: of the rows with authors the most written-out given names, then likewise.
    Remaining ties go to the smallest paper_no. No row for a field that no row has. Unknown or NULL
    feeds rank last; repeated paper_no count once each; empty tables give an empty result. ``groups``
    is what ``group_papers`` gives, if it is there already."""
    groups = stage(group_papers(papers), "groups") if groups is None else groups
    rows = placed(value_classes(_grouped(papers, feeds, groups))).where("has")
    best = F.max(F.struct("merit", (-F.col("trust_rank")).alias("trust"), "t", "depth", (-F.col("paper_no")).alias("no"))).alias("best")
    return rows.groupBy("first_no", "field").agg(best).select("first_no", "field", (-F.col("best.no")).alias("from_no"))


def merged_records(papers: DataFrame, feeds: DataFrame) -> DataFrame:
    """(first_no, doi, arxiv, authors, n_documents) of every group of two or more rows."""
    groups = stage(group_papers(papers), "groups")
    best = stage(best_rows(papers, feeds, groups), "best")
    src = papers.select(F.col("paper_no").alias("from_no"), doi_key(F.col("doi")).alias("doi"), arxiv_key(F.col("arxiv")).alias("arxiv"), "authors")
    took = best.join(src, "from_no").groupBy("first_no").agg(
        F.max(F.when(F.col("field") == "doi", F.col("doi"))).alias("doi"),
        F.max(F.when(F.col("field") == "arxiv", F.col("arxiv"))).alias("arxiv"),
        F.max(F.when(F.col("field") == "authors", F.col("authors"))).alias("authors"),
    )
    docs = merged_documents(papers, groups).groupBy("first_no").agg(F.count(F.lit(1)).alias("n_documents"))
    return took.join(docs, "first_no", "left").withColumn("n_documents", F.coalesce("n_documents", F.lit(0)))


def merged_documents(papers: DataFrame, groups: DataFrame | None = None) -> DataFrame:
    """(first_no, document): the documents of all rows of a paper, each once."""
    groups = stage(group_papers(papers), "groups") if groups is None else groups
    return papers.select("paper_no", F.explode("documents").alias("document")).where("document is not null").join(groups, "paper_no").select("first_no", "document").distinct()
