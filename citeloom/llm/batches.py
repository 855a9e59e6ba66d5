"""Problem 4: deduplicating new batches against all history.

Every text gets a fingerprint of ``LANES`` 16-bit lanes, each the low bits of one min-hash over
its word sequences, so that the number of differing bits falls with the similarity. The
fingerprints are stored in ``LANES`` rotated block tables: table t is keyed by the lanes t, t+5,
t+17 and t+40. A new batch is looked up by exact block matches, verified by the Hamming distance
of the fingerprints and then by the texts, and appended (``HistoryIndex``); history is never
fingerprinted, shuffled or sorted again.

Plain sign-of-sum fingerprints were rejected: at a similarity of one half more than a quarter
of their bits differ, so no usable block would match. With min-hash lanes a block of four
matches with probability s^4. The tables are not independent, since each lane serves four of
them: with 96 lanes a simulation lost 0.99 % of the pairs at s = 0.5. With 192 it lost 0.005 % of
100,000 pairs at s = 0.5, 0.003 % at 0.52 and none at 0.55 and 0.6."""

from __future__ import annotations

import functools
import hashlib
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citeloom.operators.components import connected_components
from citeloom.operators.skew import PIECE, hot_split_join, within_blocks
from citeloom.session import MAX_BROADCAST_ROWS, drop_at_exit, shared_dir, stage

#: No two tables share more than one lane: the differences of the offsets are all different.
LANES, OFFSETS = 192, (0, 5, 17, 40)
#: Fingerprints at similarity s differ in some 1,536 * (1 - s) of 3,072 bits, unrelated ones in
#: 1,536; at one half the deviation is 59, so that this bound lets 0.999999 of such pairs through.
MAX_BITS = 1050
SHINGLE, THRESHOLD = 3, 0.5
#: Texts hashed at once: few, so that the arrays stay in the cache.
CHUNK_ROWS = 128

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_MULT = np.random.default_rng(20240229).integers(1, 2**63, LANES, dtype=np.uint64) * _U(2) + _U(1)


def words_of(text: Column) -> Column:
    """The words of a text in lower case, one blank between."""
    return F.trim(F.lower(F.regexp_replace(text, r"[^\p{L}\p{N}]+", " ")))


_WORD = re.compile(r"[^\W_]+")


def words_in(text: str) -> str:
    """``words_of`` of one string."""
    return " ".join(_WORD.findall(text)).lower()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def shingle_hashes(texts: list[str], size: int) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all sequences of ``size`` words of normalised texts, text after text, and
    the number of them in each text. All texts are hashed at once with a polynomial prefix sum."""
    buf = np.frombuffer(("\n".join(texts) + "\n").encode(), np.uint8)
    power = np.empty(len(buf) + 1, _U)
    power[0] = 1
    np.multiply.accumulate(np.full(len(buf), _BASE | _U(1)), out=power[1:])
    total = np.zeros(len(buf) + 1, _U)
    np.cumsum((buf.astype(_U) + _U(1)) * power[:-1], out=total[1:])
    ends = np.flatnonzero((buf == 32) | (buf == 10))
    starts = np.concatenate(([0], ends[:-1] + 1))
    line_end = buf[ends] == 10
    inverse = _U(pow(int(_BASE | _U(1)), -1, 2**64))
    back = np.empty(len(buf) + 1, _U)
    back[0] = 1
    np.multiply.accumulate(np.full(len(buf), inverse), out=back[1:])
    word = _mix((total[ends] - total[starts]) * back[starts])
    per_line = np.diff(np.concatenate(([0], np.flatnonzero(line_end) + 1)))
    per_line = np.where([t == "" for t in texts], 0, per_line)
    blank = np.zeros(len(ends), bool)
    blank[np.flatnonzero(line_end)[[i for i, t in enumerate(texts) if t == ""]]] = True
    word = word[~blank]
    h = np.zeros(len(word), _U)
    for k in range(size):
        h = _mix(h * _U(31) + np.concatenate((word[k:], np.zeros(min(k, len(word)), _U))))
    count = np.maximum(per_line - size + 1, 0)
    first = np.concatenate(([0], np.cumsum(per_line)[:-1]))
    keep = np.repeat(first - np.concatenate(([0], np.cumsum(count)[:-1])), count) + np.arange(count.sum())
    return h[keep], count


def fingerprints(texts: list[str]) -> list[bytes | None]:
    """The fingerprint of every normalised text; None for texts of fewer than three words."""
    h, count = shingle_hashes(texts, SHINGLE)
    some = np.flatnonzero(count)
    out: list[bytes | None] = [None] * len(texts)
    if not len(some):
        return out
    at = np.concatenate(([0], np.cumsum(count[some])[:-1]))
    lanes = np.empty((len(some), LANES), np.uint16)
    for i in range(LANES):
        lanes[:, i] = np.minimum.reduceat((h * _MULT[i]) >> _U(32), at).astype(np.uint16)
    for k, i in enumerate(some):
        out[i] = lanes[k].tobytes()
    return out


def _fingerprint(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for lo in range(0, b.num_rows, CHUNK_ROWS):
            part = [words_in(t) for t in b.column(2).slice(lo, CHUNK_ROWS).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0).slice(lo, CHUNK_ROWS), b.column(1).slice(lo, CHUNK_ROWS),
                 pa.array([hashlib.blake2b(t.encode(), digest_size=16).digest() for t in part], pa.binary()), pa.array(fingerprints(part), pa.binary())],
                names=["doc_id", "batch_no", "copy_key", "fp"],
            )


FP = "doc_id long, batch_no int, copy_key binary, fp binary"


def fingerprint_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", batch_no: str = "batch_no") -> DataFrame:
    """(doc_id, batch_no, copy_key, fp) of every document with at least three words. ``copy_key``
    is equal for texts of the same words in the same order."""
    src = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(batch_no).cast("int").alias("batch_no"), F.col(text).alias("text"))
    return src.where("doc_id is not null and batch_no is not null and text is not null").mapInArrow(_fingerprint, FP).where("fp is not null")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        if not b.num_rows:
            continue
        lanes = np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint16).reshape(-1, LANES).astype(_U)
        t = np.arange(LANES)
        key = np.zeros(lanes.shape, _U)
        for o in OFFSETS:
            key = key << _U(16) | lanes[:, (t + o) % LANES]
        key = _mix(key + t.astype(_U) * _BASE).astype(np.int64).ravel()
        yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(np.repeat(b.column(0).to_numpy(), LANES))], names=["block", "doc_id"])


def block_tables(fps: DataFrame) -> DataFrame:
    """(block, doc_id): the rotated block tables, in one; the table number is part of the key."""
    return fps.select("doc_id", "fp").mapInArrow(_blocks, "block long, doc_id long")


@F.pandas_udf(T.IntegerType())
def _distance(a: pd.Series, b: pd.Series) -> pd.Series:
    x = np.frombuffer(b"".join(a), np.uint8).reshape(len(a), -1) if len(a) else np.zeros((0, 1), np.uint8)
    y = np.frombuffer(b"".join(b), np.uint8).reshape(len(b), -1) if len(b) else np.zeros((0, 1), np.uint8)
    return pd.Series(np.bitwise_count(x ^ y).sum(axis=1).astype(np.int32))


@F.pandas_udf(T.DoubleType())
def _similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    def grams(t: str) -> set:
        w = t.split(" ")
        return {tuple(w[i : i + SHINGLE]) for i in range(len(w) - SHINGLE + 1)}

    out = []
    for s, t in zip(a, b):
        x, y = grams(s), grams(t)
        n = len(x & y)
        out.append(n / (len(x) + len(y) - n) if x and y else 0.0)
    return pd.Series(out, dtype="float64")


def id_ranges(ids: DataFrame, lo: int | None, hi: int | None, most: int = 64) -> list[tuple[int, int]]:
    """At most ``most`` ranges that hold all values of the one BIGINT column of ``ids``, which lie from
    ``lo`` to ``hi``, as narrow as the values allow. Only a thousand or so cells reach the driver."""
    if lo is None or hi is None:
        return []
    c = F.col(ids.columns[0])
    cells = sorted(ids.groupBy(F.floor((c - lo) / ((hi - lo) // 1000 + 1))).agg(F.min(c).alias("a"), F.max(c).alias("b")).select("a", "b").collect())
    gaps = sorted(range(1, len(cells)), key=lambda k: cells[k - 1]["b"] - cells[k]["a"])[: most - 1]
    cuts = [0, *sorted(gaps), len(cells)]
    return [(cells[i]["a"], cells[j - 1]["b"]) for i, j in zip(cuts, cuts[1:])]


def only(df: DataFrame, ids: DataFrame, column: str) -> DataFrame:
    """The rows of ``df`` whose ``column`` is in the staged one-column ``ids``. The ranges of the ids go to
    the scan, so that where ``df`` lies by ``column`` only the row groups around them are read."""
    lo, hi, n = ids.agg(F.min(ids.columns[0]), F.max(ids.columns[0]), F.count(F.lit(1))).first()
    near = [F.col(column).between(a, b) for a, b in id_ranges(ids, lo, hi)]
    some = df.where(functools.reduce(Column.__or__, near)) if near else df.limit(0)
    ids = ids.toDF(column)
    return some.join(F.broadcast(ids) if n <= MAX_BROADCAST_ROWS else ids, column, "left_semi")


def verified_pairs(candidates: DataFrame, fps: DataFrame, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(a, b, similarity) of the staged candidate pairs (a, b) that pass the Hamming distance of the
    fingerprints (rep, fp) and then the exact comparison of their texts. Of fingerprints and texts
    only those of candidates are looked up."""
    ends = lambda pairs: stage(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct(), "ends")
    fps = only(fps.select("rep", "fp"), ends(candidates), "rep")
    fa, fb = fps.toDF("a", "fp_a"), fps.toDF("b", "fp_b")
    near = stage(candidates.join(fa, "a").join(fb, "b").where(_distance("fp_a", "fp_b") <= MAX_BITS).select("a", "b"), "near")
    texts = only(docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("t")), ends(near), "id").select("id", words_of(F.col("t")).alias("t")).dropDuplicates(["id"])
    ta, tb = texts.toDF("a", "text_a"), texts.toDF("b", "text_b")
    return near.join(ta, "a").join(tb, "b").select("a", "b", _similarity("text_a", "text_b").alias("similarity")).where(F.col("similarity") >= threshold)


class HistoryIndex:
    """All accepted documents, kept under ``path``, which every executor must reach:

    * ``blocks`` (block, rep): the rotated block tables of all different texts, bucketed by block,
    * ``texts`` (rep, copy_key, fp): their fingerprints; ``rep`` is the first document with the text,
    * ``members`` (doc_id, batch_no, rep): every document with its text,
    * ``links`` (a, b, similarity): the similar pairs of different texts.

    A batch is one commit: its rows carry the number of the attempt, and only attempts named in
    ``commits`` are read, so that a batch is seen whole or not at all, and accepting it again after a
    failure, or twice, changes nothing. A look-up shuffles and sorts the batch only: buckets of history are
    streamed past the hashed blocks of the batch. The number of buckets is fixed by the first batch,
    with room for a growth to four times of it before buckets exceed 64 MB."""

    TABLES = {"texts": "rep long, copy_key binary, fp binary, attempt int", "members": "doc_id long, batch_no int, rep long, attempt int", "links": "a long, b long, similarity double, attempt int"}

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path, self._blocks = spark, path.rstrip("/"), f"citeloom_blocks_{uuid.uuid4().hex}"

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        p, fs = self._fs(f"{self.path}/{folder}")
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def _mark(self, folder: str, name: str) -> None:
        p, fs = self._fs(f"{self.path}/{folder}/{name}")
        fs.create(p, False).close()

    def attempts(self) -> dict[str, int]:
        """The attempt that counts for each accepted batch, by batch number."""
        return {b: int(n) for b, n in (x.rsplit("=", 1) for x in self._names("commits"))}

    def table(self, name: str) -> DataFrame:
        """The accepted rows of ``texts``, ``members`` or ``links``."""
        rows = self.spark.read.schema(self.TABLES[name]).parquet(f"{self.path}/{name}") if self._names(name) else self.spark.createDataFrame([], self.TABLES[name])
        return rows.where(F.col("attempt").isin(list(self.attempts().values()))).drop("attempt")

    def _append(self, name: str, rows: DataFrame, attempt: int) -> None:
        rows.withColumn("attempt", F.lit(attempt)).write.mode("append").option("compression", "zstd").parquet(f"{self.path}/{name}")

    def _block_table(self, first: DataFrame) -> int:
        """Register the block table in this session; returns its number of buckets."""
        made = self._names("buckets")
        if not made:
            size, n = first.count() * LANES * 16, 8
            while n * (64 << 20) < 4 * size:
                n *= 2
            self._mark("buckets", str(n))
            made = [str(n)]
        n = int(made[0])
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self._blocks} (block BIGINT, rep BIGINT, attempt INT) USING parquet CLUSTERED BY (block) INTO {n} BUCKETS LOCATION '{self.path}/blocks'")
        return n

    def candidates(self, attempt: int, old: list[int]) -> DataFrame:
        """(a, b): texts of this attempt and texts of it or of accepted batches that share a block.

        History is read once, by bucket, past the hashed blocks of the batch; what matches is little.
        Blocks of several texts are paired in pieces."""
        blocks = self.spark.table(self._blocks)
        new = blocks.where(F.col("attempt") == attempt).select("block", "rep")
        several = new.groupBy("block").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("block")
        shared = None
        if old:
            shared = stage(blocks.where(F.col("attempt").isin(old)).select("block", "rep").join(new.select("block").hint("shuffle_hash"), "block", "left_semi"), "matched")
            several = several.unionByName(shared.select("block"))
        own = new.join(stage(several, "several").hint("shuffle_hash"), "block", "left_semi").withColumn("lead", F.lit(True))
        rows = own if shared is None else own.unionByName(shared.withColumn("lead", F.lit(False)))
        return stage(within_blocks(stage(rows, "shared"), "block", "rep", "lead").distinct(), "cand")

    def accept(self, batch: int | str, fps: DataFrame, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> None:
        """Look up a batch and append it. ``fps`` are its fingerprints, staged; ``docs`` holds the texts of
        the batch and of history. A batch that was accepted before is left alone, documents that were
        in an earlier batch are not taken again."""
        old = self.attempts()
        if str(batch) in old:
            return
        attempt = uuid.uuid4().int % (1 << 31)
        n = self._block_table(fps)
        fps = fps.dropDuplicates(["doc_id"]).join(self.table("members").select("doc_id"), "doc_id", "left_anti")
        known = self.table("texts").select("copy_key", "rep")
        reps = stage(fps.groupBy("copy_key").agg(F.min("doc_id").alias("own"), F.count(F.lit(1)).alias("n")).join(known, "copy_key", "left"), "reps")
        members = hot_split_join(fps.select("doc_id", "batch_no", "copy_key"), reps, "copy_key", "n").select("doc_id", "batch_no", F.coalesce("rep", "own").alias("rep"))
        fresh = stage(fps.join(reps.where("rep is null").select(F.col("own").alias("doc_id")), "doc_id", "left_semi").select(F.col("doc_id").alias("rep"), "copy_key", "fp"), "fresh")
        blocks = block_tables(fresh.withColumnRenamed("rep", "doc_id")).withColumn("attempt", F.lit(attempt))
        blocks.repartition(n, "block").write.insertInto(self._blocks)
        pairs = self.candidates(attempt, list(old.values()))
        links = verified_pairs(pairs, self.table("texts").select("rep", "fp").unionByName(fresh.select("rep", "fp")), docs, doc_id, text)
        for name, rows in (("members", members), ("texts", fresh), ("links", links)):
            self._append(name, rows, attempt)
        self._mark("commits", f"{batch}={attempt}")


def history_of(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", batch_no: str = "batch_no") -> HistoryIndex:
    """An index that has accepted all batches of ``docs``, one after the other, in order of ``batch_no``.

    ``members`` maps every document to the first one of the same words, ``links`` pairs such
    representatives whose sets of three-word sequences share at least half of their union. Copies
    are never compared with each other, so a group of copies holding a third of all rows costs one row
    per copy. Texts of fewer than three words and rows without id, text or batch are left out;
    repeated rows of one doc_id count once, in their first batch; empty tables give an empty index."""
    spark = docs.sparkSession
    root = f"{shared_dir(spark)}/citeloom-history-{uuid.uuid4().hex}"
    drop_at_exit(spark, root)
    fingerprint_documents(docs, doc_id, text, batch_no).write.partitionBy("batch_no").parquet(f"{root}/arrived")
    arrived = spark.read.schema(FP).parquet(f"{root}/arrived")
    index = HistoryIndex(spark, f"{root}/index")
    for r in arrived.select("batch_no").distinct().orderBy("batch_no").collect():
        index.accept(r["batch_no"], arrived.where(F.col("batch_no") == r["batch_no"]), docs, doc_id, text)
    return index


def near_classes(docs: DataFrame) -> DataFrame:
    """(doc_id, class_id, n_links): one row per document with its class of near-copies and the
    number of other distinct texts its own is linked to."""
    index = history_of(docs)
    members, pairs = index.table("members"), index.table("links")
    ends = pairs.select(F.col("a").alias("rep")).unionAll(pairs.select("b")).groupBy("rep").agg(F.count(F.lit(1)).alias("n_links"))
    comp = connected_components(pairs).withColumnRenamed("node", "rep")
    return (
        members.join(comp, "rep", "left").join(ends, "rep", "left")
        .select("doc_id", F.coalesce("component", "rep").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    )


def batch_pairs(docs: DataFrame) -> DataFrame:
    """(doc_a, doc_b), doc_a < doc_b: near-copies of different batches, copies included.

    Classes of copies are cut into pieces of ``PIECE`` documents, and pairs of pieces are joined, so
    that a class of a third of all documents is no single task."""
    index = history_of(docs)
    members, pairs = index.table("members"), index.table("links").select("a", "b")
    sizes = members.groupBy("rep").agg(F.count(F.lit(1)).alias("n"), F.min("batch_no").alias("lo"), F.max("batch_no").alias("hi"))
    sizes = stage(sizes.withColumn("pieces", F.ceil(F.col("n") / PIECE).cast("int")), "sizes")
    piece = F.pmod(F.xxhash64("doc_id"), F.col("pieces")).cast("int").alias("piece")
    cut = stage(hot_split_join(members, sizes, "rep", "n").select("rep", piece, "doc_id", "batch_no"), "cut")
    links = pairs.unionByName(sizes.where("lo < hi").select(F.col("rep").alias("a"), F.col("rep").alias("b")))
    count = lambda side: sizes.select(F.col("rep").alias(side), F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias(f"p{side}"))
    side = lambda name: cut.toDF(name, f"p{name}", f"doc_{name}", f"batch_{name}")
    out = links.join(count("a"), "a").join(count("b"), "b").join(side("a"), ["a", "pa"]).join(side("b"), ["b", "pb"])
    out = out.where("batch_a <> batch_b and (a <> b or doc_a < doc_b)")
    return out.select(F.least("doc_a", "doc_b").alias("doc_a"), F.greatest("doc_a", "doc_b").alias("doc_b"))


def batch_papers(docs: DataFrame, papers: DataFrame) -> DataFrame:
    """(doc_id, like_doc, paper_id): for every document of a later batch that is like one of an
    earlier batch, the earliest such document and the paper it belongs to: its paper_id, or
    else the paper whose documents name its hash (the smallest id of several); NULL if none."""
    info = docs.select("doc_id", "batch_no", "paper_id", "sha256").dropDuplicates(["doc_id"])
    pairs = batch_pairs(docs)
    both = pairs.unionAll(pairs.select(F.col("doc_b"), F.col("doc_a"))).toDF("doc_id", "like_doc")
    a, b = info.select("doc_id", F.col("batch_no").alias("own")), info.select(F.col("doc_id").alias("like_doc"), F.col("batch_no").alias("earlier"), "paper_id", "sha256")
    listed = papers.select(F.explode("documents").alias("sha256"), F.col("id").alias("listed_id")).groupBy("sha256").agg(F.min("listed_id").alias("listed_id"))
    found = both.join(a, "doc_id").join(b, "like_doc").where("earlier < own").join(listed, "sha256", "left")
    pick = F.min(F.struct("earlier", "like_doc", F.coalesce("paper_id", "listed_id").alias("paper_id"))).alias("m")
    return found.groupBy("doc_id").agg(pick).select("doc_id", "m.like_doc", "m.paper_id")
