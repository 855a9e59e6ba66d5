"""Problem 10: long exact spans shared between records, by prefix-partitioned suffix trees.

A suffix tree over all suffixes of the corpus would hold one leaf per character. The trees here
are sparse: only suffixes at *anchors* are inserted. In every window of ``min_chars`` characters
the ``PREFIX``-character sequence with the least hash is an anchor, so two equal stretches of
that length always hold an anchor at the same place. Anchors whose sequence occurs in one
document only are dropped by counting hashes; the texts of the others are cut into suffixes with
their left contexts, partitioned by their prefix.

A partition of more than ``MAX_TREE`` different contexts gets longer prefixes until it fits. A
stretch of ``min_chars`` may reach to both sides of its anchor, so prefixes grow to both sides: the
suffixes that agree on ``r`` characters from the anchor on become partitions of their own, and so do
those that agree on ``min_chars - r + 1`` characters before it. Two suffixes that share
``min_chars`` around the anchor are in one of these. What all suffixes of a partition have in common
(between the least and the greatest of them) is known before it is cut; if that is a stretch of
``min_chars`` it counts for all of them, and only longer agreements are followed.

Each partition's tree is built from its sorted suffixes; an internal node at depth d says that
its leaves agree on d characters to the right, and the best agreement to the left among the
leaves of one node, found in the order of the reversed left contexts, completes the maximal
repeat."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from citeloom.operators.skew import hot_split_join
from citeloom.session import small_side, stage

PREFIX = 32
#: Suffixes of one tree built in a single task (some 600 characters each, so 5 MB).
MAX_TREE = 4096
#: Characters hashed at once; longer texts are hashed alone.
CHUNK = 1 << 18

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15 | 1)
_INVERSE = _U(pow(int(_BASE), -1, 2**64))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(31))) * _U(0x7FB5D329728EA185)
    x = (x ^ (x >> _U(27))) * _U(0x81DADEF4BC2DD44D)
    return x ^ (x >> _U(33))


def gram_hashes(codes: np.ndarray, size: int) -> np.ndarray:
    """64-bit hashes of all sequences of ``size`` characters."""
    n = len(codes)
    if n < size:
        return np.empty(0, _U)
    power = np.empty(n + 1, _U)
    power[0] = 1
    np.multiply.accumulate(np.full(n, _BASE), out=power[1:])
    total = np.zeros(n + 1, _U)
    np.cumsum((codes.astype(_U) + _U(1)) * power[:-1], out=total[1:])
    back = np.empty(n + 1, _U)
    back[0] = 1
    np.multiply.accumulate(np.full(n, _INVERSE), out=back[1:])
    return _mix((total[size:] - total[:-size]) * back[: n - size + 1])


def _window_min(x: np.ndarray, w: int) -> np.ndarray:
    """The least of every ``w`` consecutive values."""
    n = len(x)
    pad = -n % w
    y = np.concatenate((x, np.full(pad, np.iinfo(np.uint64).max, _U))).reshape(-1, w)
    left = np.minimum.accumulate(y, axis=1).ravel()
    right = np.minimum.accumulate(y[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[: n - w + 1], left[w - 1 : n])


def anchors(texts: list[str], min_chars: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(positions, hashes) of the anchors of every text."""
    w = min_chars - PREFIX + 1
    out: list[tuple[np.ndarray, np.ndarray]] = [(np.empty(0, np.int64), np.empty(0, _U))] * len(texts)
    lo = 0
    while lo < len(texts):
        hi, chars = lo, 0
        while hi < len(texts) and (hi == lo or chars + len(texts[hi]) <= CHUNK):
            chars += len(texts[hi])
            hi += 1
        codes = np.frombuffer("".join(texts[lo:hi]).encode("utf-32-le", "surrogatepass"), np.uint32)
        h = gram_hashes(codes, PREFIX)
        if len(h) >= w:
            bits = _U(max(1, int(len(h)).bit_length()))
            low = (_U(1) << bits) - _U(1)
            # high bits of the hash, then the place from the right: the last of equal ones wins
            packed = (h & ~low) | (low - np.arange(len(h), dtype=_U))
            place = (low - (_window_min(packed, w) & low)).astype(np.int64)
            at = 0
            for k in range(lo, hi):
                n = len(texts[k]) - min_chars + 1
                if n > 0:
                    p = np.unique(place[at : at + n])
                    out[k] = (p - at, h[p])
                at += len(texts[k])
        lo = hi
    return out


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The batches in small pieces, so that a worker holds few texts and contexts at once."""
    for b in batches:
        for lo in range(0, b.num_rows, rows):
            yield b.slice(lo, rows)


MARKS = "doc_id long, copy_key binary, n long, pos array<int>, h array<long>"


def _mark(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches):
            texts = b.column(1).to_pylist()
            found = anchors(texts, min_chars)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([hashlib.blake2b(t.encode("utf-8", "surrogatepass"), digest_size=16).digest() for t in texts], pa.binary()), pa.array([len(t) for t in texts], pa.int64()),
                 pa.array([p.astype(np.int32) for p, _ in found], pa.list_(pa.int32())), pa.array([h.astype(np.int64) for _, h in found], pa.list_(pa.int64()))],
                names=["doc_id", "copy_key", "n", "pos", "h"],
            )

    return run


CONTEXT = "h long, doc_id long, pos long, before string, after string"


def _contexts(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches):
            cols: tuple[list, ...] = ([], [], [], [], [])
            for doc, text, places in zip(*(c.to_pylist() for c in b.columns)):
                for a in places:
                    x = a["pos"]
                    for c, v in zip(cols, (a["h"], doc, x, text[max(0, x - min_chars + PREFIX) : x], text[x : x + min_chars])):
                        c.append(v)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["h", "doc_id", "pos", "before", "after"])

    return run


def common_prefix(a: str, b: str) -> int:
    """How many characters two strings agree on from the start."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    lo, hi = 0, n
    while hi - lo > 1:
        mid = (lo + hi) // 2
        if a[:mid] == b[:mid]:
            lo = mid
        else:
            hi = mid
    return lo


def tree_repeats(docs: list[int], before: list[str], after: list[str], min_chars: int) -> set[tuple[int, int, int]]:
    """(leaf, left, right): leaf agrees with a leaf of another document on ``left`` characters before
    its anchor and ``right`` from it on, together at least ``min_chars``. All such maximal pairs
    are covered."""
    n = len(docs)
    order = sorted(range(n), key=after.__getitem__)
    back = [s[::-1] for s in before]
    rank = {i: k for k, i in enumerate(sorted(range(n), key=back.__getitem__))}
    lcp = [common_prefix(after[a], after[b]) for a, b in zip(order, order[1:])]
    longest = max(map(len, before), default=0)
    found: set[tuple[int, int, int]] = set()

    def node(lo: int, hi: int, depth: int) -> None:
        """The internal node whose leaves are order[lo..hi]."""
        if depth + longest < min_chars:
            return
        leaves = sorted(order[lo : hi + 1], key=rank.__getitem__)
        for seq in (leaves, leaves[::-1]):
            last = other = -1  # the latest leaf, and the latest of a document other than its
            for i in seq:
                if last >= 0 and docs[last] != docs[i]:
                    other = last
                if other >= 0 and docs[other] != docs[i]:
                    left = common_prefix(back[i], back[other])
                    if left + depth >= min_chars:
                        found.add((i, left, depth))
                        found.add((other, left, depth))
                last = i

    # internal nodes are the intervals of the longest-common-prefix array
    stack: list[tuple[int, int]] = []
    for k, d in enumerate([*lcp, -1]):
        start = k
        while stack and stack[-1][1] > d:
            start, depth = stack.pop()
            node(start, k, depth)
        if d >= 0 and (not stack or stack[-1][1] < d):
            stack.append((start, d))
    return found


SPAN = "doc_id long, first long, last long"


def _trees(min_chars: int):
    """(part, doc_id, pos, before, after) sorted by ``part`` to the spans its tree finds."""

    def spans(rows: list[tuple]) -> Iterator[tuple[int, int, int]]:
        by: dict[tuple[str, str], list[tuple[int, int]]] = {}
        for _, doc, pos, before, after in rows:
            by.setdefault((before, after), []).append((doc, pos))
        docs, b, a, at = [], [], [], []
        for (before, after), places in by.items():
            # equal contexts are one leaf, entered twice if they are of different documents
            first = places[0][0]
            other = next((d for d, _ in places if d != first), None)
            for d in (first,) if other is None else (first, other):
                docs.append(d)
                b.append(before)
                a.append(after)
                at.append(places)
        best: dict[int, set[tuple[int, int]]] = {}
        for leaf, left, right in tree_repeats(docs, b, a, min_chars):
            best.setdefault(id(at[leaf]), set()).add((left, right))
        for places in by.values():
            for left, right in best.get(id(places), ()):
                for d, p in places:
                    yield d, p - left, p + right

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[tuple] = []
        for b in batches:
            out: list[tuple[int, int, int]] = []
            for row in zip(*(c.to_pylist() for c in b.columns)):
                if group and row[0] != group[0][0]:
                    out += spans(group)
                    group = []
                group.append(row)
            if out:
                yield _batch(out)
        if out := list(spans(group)):
            yield _batch(out)

    return run


def _batch(rows: list[tuple[int, int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=["doc_id", "first", "last"])


def _leaf_trees(min_chars: int):
    """(part, leaf, lo, hi, before, after) sorted by ``part`` to (leaf, left, right) of its tree."""

    def found(rows: list[tuple]) -> list[tuple[str, int, int]]:
        leaves = [(leaf, d, before, after) for _, leaf, lo, hi, before, after in rows for d in ((lo,) if lo == hi else (lo, hi))]
        ids, docs, b, a = zip(*leaves)
        return list({(ids[i], left, right) for i, left, right in tree_repeats(list(docs), list(b), list(a), min_chars)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[tuple] = []

        def flush() -> Iterator[pa.RecordBatch]:
            if group and (out := found(group)):
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), (pa.string(), pa.int32(), pa.int32()))], names=["leaf", "left", "right"])

        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns)):
                if group and row[0] != group[0][0]:
                    yield from flush()
                    group.clear()
                group.append(row)
        yield from flush()

    return run


def _sizes(rows: DataFrame, lo: str, hi: str) -> DataFrame:
    """(part, n) of the partitions with several documents; rows are counted on the map side."""
    sizes = rows.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.min(lo).alias("lo"), F.max(hi).alias("hi"))
    return stage(sizes.where("lo < hi").select("part", "n"), "sizes")


def _agreement(x: str, y: str, longest: int) -> Column:
    """How many characters two strings agree on from the start."""
    same = F.filter(F.sequence(F.lit(1), F.lit(longest)), lambda k: (k > F.length(x)) | (k > F.length(y)) | (F.substring(x, F.lit(1), k) != F.substring(y, F.lit(1), k)))
    return F.coalesce(F.get(same, F.lit(0)), F.lit(longest + 1)) - 1


def leaf_agreements(leaves: DataFrame, min_chars: int) -> DataFrame:
    """(leaf, left, right) of the agreements of at least ``min_chars`` among ``leaves`` (part, leaf, lo,
    hi, before, after), whose partitions are too large for one tree unless cut."""
    rows, found = leaves.select("part", "leaf", "lo", "hi", "before", "after"), None  # the trees read by place
    while True:
        sizes = _sizes(rows, "lo", "hi")
        small = rows.join(sizes.where(F.col("n") <= MAX_TREE).select("part"), "part", "left_semi")
        trees = small.repartition("part").sortWithinPartitions("part").mapInArrow(_leaf_trees(min_chars), "leaf string, left int, right int")
        found = trees if found is None else found.unionByName(trees)
        large = sizes.where(F.col("n") > MAX_TREE)
        if not large.limit(1).count():
            return found
        rows = stage(hot_split_join(rows, large, "part", "n").drop("n"), "large")
        ends = rows.groupBy("part").agg(
            F.count(F.lit(1)).alias("n"), F.min("after").alias("a0"), F.max("after").alias("a1"), F.min(F.reverse("before")).alias("b0"), F.max(F.reverse("before")).alias("b1")
        )
        common = stage(ends.select("part", "n", _agreement("a0", "a1", min_chars).alias("right"), _agreement("b0", "b1", min_chars).alias("left")), "common")
        rows = stage(hot_split_join(rows, common, "part", "n").drop("n"), "cut")
        whole = F.col("right") + F.col("left") >= min_chars
        found = found.unionByName(rows.where(whole).select("leaf", "left", "right"))
        middle = F.floor((F.col("right") + min_chars + 1 - F.col("left")) / 2).cast("int")
        r = F.when(whole, F.col("right") + 1).otherwise(middle)
        other = F.when(whole, F.col("left") + 1).otherwise(F.lit(min_chars + 1) - middle)
        go_on = F.array_compact(F.array(
            F.when(F.length("after") >= r, F.xxhash64("part", F.lit(0), F.substring("after", F.lit(1), r))), F.when(F.length("before") >= other, F.xxhash64("part", F.lit(1), F.right("before", other))),
        ))
        rows = stage(rows.select(F.explode(go_on).alias("part"), "leaf", "lo", "hi", "before", "after"), "longer")


def partition_spans(contexts: DataFrame, min_chars: int) -> DataFrame:
    """(doc_id, first, last) of the stretches shared around the anchors of ``contexts`` (``CONTEXT``)."""
    rows = contexts.withColumnRenamed("h", "part")
    sizes = _sizes(rows, "doc_id", "doc_id")
    small = rows.join(sizes.where(F.col("n") <= MAX_TREE).select("part"), "part", "left_semi").select("part", "doc_id", "pos", "before", "after")
    spans = small.repartition("part").sortWithinPartitions("part").mapInArrow(_trees(min_chars), SPAN)
    large = sizes.where(F.col("n") > MAX_TREE)
    if not large.limit(1).count():
        return spans
    # in a large partition equal contexts become one leaf first
    leaf = F.md5(F.concat_ws("\u0000", F.col("part").cast("string"), F.length("before").cast("string"), "before", "after"))
    rows = stage(hot_split_join(rows, large, "part", "n").drop("n").withColumn("leaf", leaf), "places")
    leaves = rows.groupBy("part", "leaf", "before", "after").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.count(F.lit(1)).alias("places"))
    leaves = stage(leaves, "leaves")
    agreed = leaf_agreements(leaves.drop("places"), min_chars).distinct().join(leaves.select("leaf", "places"), "leaf")
    agreed = stage(agreed.groupBy("leaf").agg(F.max("places").alias("places"), F.collect_set(F.struct("left", "right")).alias("s")), "agreed")
    hits = hot_split_join(rows.select("leaf", "doc_id", "pos"), agreed, "leaf", "places").select("doc_id", "pos", F.explode("s").alias("s"))
    return spans.unionByName(hits.select("doc_id", (F.col("pos") - F.col("s.left")).alias("first"), (F.col("pos") + F.col("s.right")).alias("last")))


def shared_spans(docs: DataFrame, min_chars: int = 300, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, first, last): the merged stretches of every document of which each place lies in a
    stretch of at least ``min_chars`` characters that also occurs in another doc_id; ``last``
    is exclusive.

    NULL ids and texts give no row, texts shorter than ``min_chars`` share nothing, a text
    repeated within itself only shares nothing, rows repeating a doc_id with the same text
    count once. Equal texts are handled once and their spans given to each of their documents.
    Empty input gives an empty result; other columns are ignored. The texts are read twice: for
    their anchors, and for the contexts of those anchors that several documents have."""
    src = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).where("doc_id is not null and text is not null")
    marks = stage(src.mapInArrow(_mark(min_chars), MARKS), "marks")
    groups = stage(marks.groupBy("copy_key").agg(F.min("doc_id").alias("rep"), F.max("doc_id").alias("last"), F.count(F.lit(1)).alias("rows")), "copygroups")
    several = groups.where("rows > 1").select("copy_key", "rep", "rows", (F.col("rep") < F.col("last")).alias("shared"))
    copies = stage(hot_split_join(marks.select("doc_id", "copy_key", "n"), several, "copy_key", "rows").select("doc_id", "rep", "n", "shared"), "copies")
    # of equal texts only the first takes part
    lone = marks.join(copies.where("doc_id <> rep").select("doc_id").distinct(), "doc_id", "left_anti")
    places = stage(lone.where(F.size("h") > 0).select("doc_id", F.inline(F.arrays_zip("h", "pos"))), "anchors")
    often = stage(places.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo < hi").select("h", "n"), "often")
    wanted = stage(hot_split_join(places, often, "h", "n").groupBy("doc_id").agg(F.collect_list(F.struct("h", "pos")).alias("places")), "wanted")
    texts = src.join(small_side(wanted.select("doc_id")), "doc_id", "left_semi").join(wanted, "doc_id").select("doc_id", "text", "places")
    contexts = stage(texts.mapInArrow(_contexts(min_chars), CONTEXT), "contexts")
    spans = stage(partition_spans(contexts, min_chars).distinct(), "spans")
    whole = copies.where(F.col("shared") & (F.col("n") >= min_chars)).select("doc_id", F.lit(0).cast("long").alias("first"), F.col("n").alias("last"))
    spans = spans.join(whole.select("doc_id"), "doc_id", "left_anti").unionByName(whole)
    w = Window.partitionBy("doc_id").orderBy("first", "last")
    reach = F.max("last").over(w.rowsBetween(Window.unboundedPreceding, -1))
    runs = spans.withColumn("new", F.when(F.col("first") <= reach, 0).otherwise(1)).withColumn("run", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return runs.groupBy("doc_id", "run").agg(F.min("first").alias("first"), F.max("last").alias("last")).drop("run")


def shared_shares(docs: DataFrame, min_chars: int = 300) -> DataFrame:
    """(doc_id, n_chars, shared_chars, share): for every document how much of it stands elsewhere."""
    got = shared_spans(docs, min_chars).groupBy("doc_id").agg(F.sum(F.col("last") - F.col("first")).alias("shared_chars"))
    size = docs.where("doc_id is not null and text is not null").select("doc_id", F.length("text").cast("long").alias("n_chars"))
    return (
        size.join(got, "doc_id", "left").withColumn("shared_chars", F.coalesce("shared_chars", F.lit(0)))
        .withColumn("share", F.round(F.coalesce(F.col("shared_chars") / F.nullif(F.col("n_chars"), F.lit(0)), F.lit(0.0)), 6))
    )
