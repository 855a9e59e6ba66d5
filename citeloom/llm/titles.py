"""Problem 1: duplicates hidden by formatting differences.

Titles that hold the same words the same number of times, in whatever order and however
punctuated, spaced or cased, are one title. Two passes: every task records the hashes of its
canonical titles in Bloom filters of hashes seen once and of hashes seen repeatedly; merging ORs
the filters and adds to the repeat filter what the once-filters of two tasks have in common.
Only rows that the merged repeat filter lets through are shuffled for exact grouping on the
canonical text; all others are proven singletons and never leave their task.

The filters grow with the rows, 16 bits for each, so the part of the unique rows that a filter
lets through stays at 1.4 % however many rows there are. The hash space is cut into ranges of at
most ``RANGE_BITS`` bits with a filter each. Rows are staged by range, so every task tests its rows
against the filter of one range only; the filters travel and are held one by one."""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeloom.operators.skew import hot_split_join
from citeloom.session import remove_path, shared_dir, stage

#: Bits per row (there are two hash functions), bits of the filter of one range (8 MB), bits of a piece that is
#: merged at once, hashes a task records at once.
BITS_PER_ROW, RANGE_BITS, SEGMENT_BITS, CHUNK = 16, 1 << 26, 1 << 19, 1 << 20

WORD = r"[\p{L}\p{N}]+"
_U = np.uint64


def title_words(title: Column) -> Column:
    """The words of a title: maximal runs of letters and digits, lower case, sorted."""
    return F.array_sort(F.regexp_extract_all(F.lower(title), F.lit(f"({WORD})"), F.lit(1)))


def canonical_title(title: Column) -> Column:
    """The words of a title in sorted order, one blank between; NULL if it has none."""
    return F.nullif(F.array_join(title_words(title), " "), F.lit(""))


def filter_size(n_rows: int) -> tuple[int, int]:
    """(number of ranges, bits of each) for so many rows; both are powers of two."""
    ranges, bits = 1, 1 << 16
    while bits < RANGE_BITS and bits < BITS_PER_ROW * n_rows:
        bits <<= 1
    while ranges * bits < BITS_PER_ROW * n_rows:
        ranges <<= 1
    return ranges, bits


def positions(h: np.ndarray, bits: int) -> np.ndarray:
    """The bits (n, 2) of 64-bit hashes within the filter of their range."""
    u = h.astype(_U)
    u = (u ^ (u >> _U(32))) * _U(0xBF58476D1CE4E5B9)
    v = (u ^ (u >> _U(29))) * _U(0x94D049BB133111EB)
    return np.stack([(x >> _U(64 - bits.bit_length() + 1)).astype(np.int64) for x in (u, v)], axis=1)


def _record(bits: int, seg_bits: int):
    """(range, hash) batches to pieces of filters: the bits set, once and repeatedly, by segment."""

    def emit(r: np.ndarray, h: np.ndarray) -> Iterator[pa.RecordBatch]:
        h, where, n = np.unique(h, return_index=True, return_counts=True)
        p = (r[where].astype(np.int64) * bits)[:, None] + positions(h, bits)
        once, twice = np.unique(p), np.unique(p[n > 1])
        segs, first = np.unique(once // seg_bits, return_index=True)
        last = np.append(first[1:], len(once))
        lo, hi = np.searchsorted(twice, segs * seg_bits), np.searchsorted(twice, (segs + 1) * seg_bits)
        pack = lambda x, s: zlib.compress(np.diff(x - s * seg_bits, prepend=0).astype(np.uint32).tobytes(), 1)
        for k in range(0, len(segs), 1024):
            part = range(k, min(k + 1024, len(segs)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(segs[k : k + 1024], pa.int64()), pa.array([pack(once[first[i] : last[i]], segs[i]) for i in part], pa.binary()), pa.array([pack(twice[lo[i] : hi[i]], segs[i]) for i in part], pa.binary())],
                names=["seg", "once", "twice"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in batches:
            held.append((b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_numpy(zero_copy_only=False)))
            n += b.num_rows
            if n >= CHUNK:
                yield from emit(*map(np.concatenate, zip(*held)))
                held, n = [], 0
        if n:
            yield from emit(*map(np.concatenate, zip(*held)))

    return run


def _merge(seg_bits: int):
    """All pieces of one segment: at most its bits from each task. What two tasks both set counts as
    set repeatedly."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        once, twice = np.zeros(seg_bits, np.bool_), np.zeros(seg_bits, np.bool_)
        for a, t in zip(pdf["once"], pdf["twice"]):
            a, t = (np.cumsum(np.frombuffer(zlib.decompress(x), np.uint32), dtype=np.int64) for x in (a, t))
            twice[a[once[a]]] = True
            twice[t] = True
            once[a] = True
        return pd.DataFrame({"seg": [pdf["seg"].iloc[0]], "bits": [zlib.compress(np.packbits(twice).tobytes(), 1)]})

    return run


def mark_repeats(rows: DataFrame, h: str, n_rows: int, *keep: str) -> DataFrame:
    """The columns ``keep`` of ``rows`` with ``maybe``: false only where the BIGINT ``h`` occurs once in
    all ``rows``, of which there are ``n_rows``. Staged; no row is shuffled."""
    spark = rows.sparkSession
    ranges, bits = filter_size(n_rows)
    seg_bits = min(SEGMENT_BITS, bits)
    src = rows.select(*keep, F.col(h).alias("_h"), F.pmod(F.col(h), F.lit(ranges)).cast("int").alias("_range"))
    path = f"{shared_dir(spark)}/citeloom-ranges-{uuid.uuid4().hex}"
    if ranges > 1:  # a folder for each range
        src.write.partitionBy("_range").parquet(path)
        parts = {r: f"{path}/_range={r}" for r in range(ranges)}
        parts = {r: spark.read.schema(src.drop("_range").schema).parquet(p) for r, p in parts.items() if _exists(spark, p)}
        hashes = spark.read.schema(src.schema).parquet(path)
    else:
        parts, hashes = {0: src}, src
    pieces = hashes.select("_range", "_h").mapInArrow(_record(bits, seg_bits), "seg long, once binary, twice binary")
    merged = stage(pieces.groupBy("seg").applyInPandas(_merge(seg_bits), "seg long, bits binary"), "filter")
    out, per_range = None, bits // seg_bits
    for r, part in parts.items():
        whole = np.zeros((per_range, seg_bits // 8), np.uint8)
        for row in merged.where(F.col("seg").between(r * per_range, (r + 1) * per_range - 1)).collect():  # RANGE_BITS at most
            whole[row["seg"] - r * per_range] = np.frombuffer(zlib.decompress(row["bits"]), np.uint8)
        tested = part.select(*keep, _tester(spark.sparkContext.broadcast(whole.ravel()), bits)("_h").alias("maybe"))
        out = tested if out is None else out.unionByName(tested)
    marked = rows.select(*keep, F.lit(False).alias("maybe")).limit(0) if out is None else stage(out, "marked")
    if ranges > 1:
        remove_path(spark, path)
    return marked


def _exists(spark, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def _tester(shared, bits: int):
    @F.pandas_udf("boolean")
    def maybe_repeated(h: pd.Series) -> pd.Series:
        p = positions(h.to_numpy(), bits)
        return pd.Series(((shared.value[p >> 3] >> (7 - (p & 7))) & 1).all(axis=1))

    return maybe_repeated


def collapse_titles(rows: DataFrame, scope: str, key: str, title: str) -> DataFrame:
    """(scope, key, canonical, first_key, copies) for every row of ``rows`` whose title has a word.

    Rows of one ``scope`` with the same canonical title form a group; ``first_key`` is its
    smallest key, ``copies`` its number of rows; a singleton has itself and 1. NULL titles, and
    titles without any letter or digit, have no words to compare: they give no row. Repeated
    rows count as often as they occur. Empty input gives an empty result; other columns are
    ignored whatever their names."""
    src = rows.select(
        F.col(scope).alias("scope"), F.col(key).alias("key"), canonical_title(F.col(title)).alias("canonical")
    ).where("canonical is not null")
    src = stage(src.withColumn("h", F.xxhash64("scope", "canonical")), "titles")
    marked = mark_repeats(src, "h", src.count(), "scope", "key", "canonical")
    single = marked.where("not maybe").select("scope", "key", "canonical", F.col("key").alias("first_key"), F.lit(1).cast("long").alias("copies"))
    maybe = marked.where("maybe").select("key", F.concat_ws("\u0001", "scope", "canonical").alias("g"))
    groups = stage(maybe.groupBy("g").agg(F.min("key").alias("first_key"), F.count(F.lit(1)).alias("copies")), "groups")
    exact = hot_split_join(maybe, groups, "g", "copies").select(
        F.split_part("g", F.lit("\u0001"), F.lit(1)).alias("scope"), "key",
        F.split_part("g", F.lit("\u0001"), F.lit(2)).alias("canonical"), "first_key", "copies",
    )
    return exact.unionByName(single)


def title_groups(members: DataFrame) -> DataFrame:
    """(scope, canonical, first_key, copies), one row per title, from ``collapse_titles``."""
    return members.where("key = first_key").select("scope", "canonical", "first_key", "copies").distinct()
