"""Joins and groupings that stay balanced when one key holds a large part of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeloom.session import stage

#: A key is hot if it holds more than this part of the rows, so at most 1/HOT_SHARE keys are hot.
HOT_SHARE = 1 / 256


def hot_split_join(big: DataFrame, groups: DataFrame, key: str, rows: str) -> DataFrame:
    """Inner join of ``big`` with ``groups`` (one row per ``key``; column ``rows`` holds how many
    rows of ``big`` carry that key).

    Keys holding more than ``HOT_SHARE`` of all counted rows, of which there can be at most
    1/HOT_SHARE = 256, are joined by broadcast, so their rows never meet in one task; all
    others are joined by a shuffle on ``key``. Nothing is dropped. ``groups`` should be staged:
    it is read three times. NULL keys join nothing. Empty inputs give an empty result."""
    total, most = groups.agg(F.sum(rows), F.max(rows)).first()
    limit = max((total or 0) * HOT_SHARE, 1)
    if (most or 0) <= limit:
        return big.join(groups, key)
    hot = groups.where(F.col(rows) > F.lit(limit))
    hot_list = hot.select(key).limit(int(1 / HOT_SHARE) + 1).collect()
    values = [r[0] for r in hot_list]
    is_hot = F.col(key).isin(values)
    return (
        big.where(is_hot).join(F.broadcast(hot), key)
        .unionByName(big.where(~is_hot).join(groups.where(~F.col(key).isin(values)), key))
    )


#: Rows of a block that are paired in one task with those of another piece of it.
PIECE = 1000


def within_blocks(rows: DataFrame, key: str, own: str, lead: str) -> DataFrame:
    """(a, b): all pairs of rows of one ``key`` of which one leads or both do, each once or twice;
    ``a`` and ``b``, a < b, are values of the column ``own``, ``lead`` is a boolean column.

    Blocks of more than ``PIECE`` rows are cut into pieces by hash, and every pair of pieces is a
    key of its own, so no task pairs more than PIECE * PIECE rows however large the block is.
    Nothing is thinned. ``rows`` should be staged; NULL keys pair nothing."""
    sizes = stage(rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1"), "sizes")
    left, right = rows.where(lead).select(key, F.col(own).alias("a")), rows.select(key, F.col(own).alias("b"), lead)
    out = left.join(sizes.where(F.col("_n") <= PIECE).select(key), key, "left_semi").join(right, key).drop(key)
    large = sizes.where(F.col("_n") > PIECE)
    if large.limit(1).count():
        piece = F.pmod(F.xxhash64(own), F.ceil(F.col("_n") / PIECE)).cast("int")
        cut = stage(hot_split_join(rows, large, key, "_n").withColumn("_piece", piece).drop("_n"), "pieces")
        parts = cut.select(key, "_piece").distinct()
        pairs = parts.withColumnRenamed("_piece", "_pa").join(parts.withColumnRenamed("_piece", "_pb"), key)
        a = cut.where(lead).select(key, F.col("_piece").alias("_pa"), F.col(own).alias("a"))
        b = cut.select(key, F.col("_piece").alias("_pb"), F.col(own).alias("b"), lead)
        out = out.unionByName(pairs.join(a, [key, "_pa"]).join(b, [key, "_pb"]).select("a", "b", lead))
    return out.where((F.col("a") < F.col("b")) | ~F.col(lead) & (F.col("a") != F.col("b"))).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
