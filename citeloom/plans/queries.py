"""Queries of the core: the packed-field problem and the citation-graph operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeloom.operators.packed import split_packed
from citeloom.plans.case_queries import case_queries, case_sql
from citeloom.plans.graph_queries import graph_queries, graph_sql
from citeloom.session import table

Query = Callable[[SparkSession, str], DataFrame]


def p6_split(spark: SparkSession, d: str) -> DataFrame:
    """Every value of refs.authors and refs.raw as a row of its own, single values included."""
    refs = table(spark, d, "refs")
    parts = [
        split_packed(refs, "ref_id", field, kind).withColumn("field", F.lit(field))
        for field, kind in (("authors", "authors"), ("raw", "citations"))
    ]
    return parts[0].unionByName(parts[1])


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """The values of fields that hold two or more (TESTDATA problem 6)."""
    return p6_split(spark, d).where("n_items > 1").select("ref_id", "field", F.col("pos").cast("int").alias("pos"), "item")


def core_queries() -> dict[str, Query]:
    return {"p6_split": p6_split, "p6_found": p6_found} | graph_queries() | case_queries()


def core_sql() -> dict[str, str]:
    return graph_sql() | case_sql()
