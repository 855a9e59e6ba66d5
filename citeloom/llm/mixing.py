"""Problem 9: mixing sources to target weights by subset-sum budget fitting.

Documents are counted by exact token length. Every source is repeated whole as often as its
budget holds it; the rest of the budget is filled by taking the same share of every length,
and what then remains, a few documents' worth, by a bounded-knapsack dynamic programme over
the lengths that are left. The chosen number of documents of each length is drawn by a seeded
hash. Only counts, never documents, are gathered."""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from citeloom.session import small_side, stage

#: Default vocabulary file; a parameter of every function that needs it.
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The splitting pattern that belongs to the byte-level vocabularies (fixed value).
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: The dynamic programme covers at least this many times the longest document.
DP_DOCUMENTS = 8
BUCKETS = 1024


def _token_counter(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        from pyspark import SparkFiles

        shipped = SparkFiles.get(os.path.basename(path))
        with open(shipped if os.path.exists(shipped) else path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        enc = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        for b in batches:
            n = [len(enc.encode_ordinary(t)) for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int64())], names=["doc_id", "source", "n_tokens"])

    return run


def token_lengths(docs: DataFrame, tokenizer: str = TOKENIZER, doc_id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """(doc_id, source, n_tokens) of every document with a text. The vocabulary file is sent from the
    driver to every executor."""
    docs.sparkSession.sparkContext.addFile(tokenizer)
    src = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(source).alias("source"), F.col(text).alias("text")).where("text is not null")
    return src.mapInArrow(_token_counter(tokenizer), "doc_id long, source string, n_tokens long")


def fit_budget(lengths: list[int], counts: list[int], budget: int) -> dict[int, int]:
    """How many documents of each length to take so that their sum comes as near to ``budget``
    as possible from below."""
    have = dict(sorted((n, c) for n, c in zip(lengths, counts) if n > 0 and c > 0))
    total = sum(n * c for n, c in have.items())
    if budget >= total:
        return have
    longest = max(have, default=0)
    # what the dynamic programme can fill exactly is kept back
    spread = max(0, budget - DP_DOCUMENTS * longest)
    take = {n: c * spread // total for n, c in have.items()}
    left = budget - sum(n * k for n, k in take.items())
    # bring the rest within reach of the dynamic programme, longest documents first
    for n in sorted(have, reverse=True):
        if left <= DP_DOCUMENTS * longest:
            break
        k = min(have[n] - take[n], (left - DP_DOCUMENTS * longest) // n + 1, left // n)
        take[n] += k
        left -= n * k
    # bounded knapsack over what is left: the step that first reached each attainable sum
    first, steps = np.full(left + 1, -1, np.int32), [(0, 0)]
    first[0] = 0
    for n, c in have.items():
        spare, size = min(c - take[n], left // n), 1
        while spare > 0:
            k = min(size, spare)
            fresh = (first[: left + 1 - n * k] >= 0) & (first[n * k :] < 0)
            if fresh.any():
                first[n * k :][fresh] = len(steps)
                steps.append((n, k))
            spare -= k
            size *= 2
        if first[left] >= 0:
            break
    at = int(np.flatnonzero(first >= 0)[-1])
    while at:
        n, k = steps[first[at]]
        take[n] += k
        at -= n * k
    return take


PLAN = "source string, n_tokens long, whole long, extra long"


def _plan(pdf: pd.DataFrame) -> pd.DataFrame:
    """For one source with its counts by length: whole repeats and extra documents by length."""
    r = pdf.iloc[0]
    total = int((pdf["n_tokens"] * pdf["n_docs"]).sum())
    target, most = int(r["target_tokens"]), max(0, int(r["max_repeats"]))
    whole = min(most, target // total) if total else 0
    extra = fit_budget(pdf["n_tokens"].tolist(), pdf["n_docs"].tolist(), target - whole * total) if total and whole < most else {}
    return pd.DataFrame({"source": r["source"], "n_tokens": pdf["n_tokens"], "whole": whole, "extra": [extra.get(int(n), 0) for n in pdf["n_tokens"]]})


def mix_plan(lengths: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, n_tokens, whole, extra, n_docs): how often each document of a source and length
    is used, and of how many one copy more. ``lengths`` from ``token_lengths``, staged."""
    hist = lengths.groupBy("source", "n_tokens").agg(F.count(F.lit(1)).alias("n_docs"))
    all_tokens = lengths.agg(F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("all_tokens"))
    want = _targets(targets).crossJoin(F.broadcast(all_tokens)).withColumn("target_tokens", F.floor(F.col("target_share") * F.col("all_tokens")))
    joined = hist.join(small_side(want), "source")
    plan = joined.groupBy("source").applyInPandas(_plan, PLAN)
    return plan.join(hist, ["source", "n_tokens"])


def _targets(targets: DataFrame) -> DataFrame:
    """One row per source; of repeated rows the largest share and number count."""
    return (
        targets.where("source is not null").groupBy("source")
        .agg(F.coalesce(F.max("target_share"), F.lit(0.0)).alias("target_share"), F.coalesce(F.max("max_repeats"), F.lit(0)).alias("max_repeats"))
    )


def mix_report(lengths: DataFrame, targets: DataFrame) -> DataFrame:
    """One row per source of ``targets``: target, what is available, what the mix holds, and the
    share reached. ``reachable`` is false if the plan uses every document of a source
    ``max_repeats`` times and still stays below its share of a mix as large as all documents
    together.

    Documents without a source count towards that total only. A source without documents
    reaches nothing. NULL shares count as 0, NULL repeats as none. Empty tables give no row."""
    have = lengths.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("docs"))
    mixed = mix_plan(lengths, targets).groupBy("source").agg(
        F.sum(F.col("n_tokens") * (F.col("whole") * F.col("n_docs") + F.col("extra"))).alias("mixed_tokens"), F.max("whole").alias("whole_repeats")
    )
    all_tokens = lengths.agg(F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("all_tokens"))
    out = _targets(targets).join(have, "source", "left").join(mixed, "source", "left").crossJoin(F.broadcast(all_tokens))
    used_up = F.coalesce(F.col("whole_repeats") >= F.col("max_repeats"), F.lit(True)).alias("used_up")
    out = out.select("*", used_up).fillna(0, ["tokens", "docs", "mixed_tokens", "whole_repeats"])
    mix = F.sum("mixed_tokens").over(Window.partitionBy(F.lit(1)))  # as many rows as there are sources
    return out.select(
        "source", "target_share", F.col("max_repeats").cast("long").alias("max_repeats"), "docs", "tokens", "whole_repeats", "mixed_tokens",
        (F.col("mixed_tokens") / F.nullif(F.col("all_tokens"), F.lit(0))).alias("share_of_budget"),
        (F.col("mixed_tokens") / F.nullif(mix, F.lit(0))).alias("share_of_mix"),
        (~(F.col("used_up") & (F.col("mixed_tokens") < F.col("target_share") * F.col("all_tokens")))).alias("reachable"),
    )


def mix_documents(lengths: DataFrame, targets: DataFrame, seed: int = 42) -> DataFrame:
    """(doc_id, source, n_tokens, copies) of the documents in the mix.

    Among the documents of one source and length the extra copies go to those with the least
    seeded hash. The rank is found by counting hash buckets first, so that only one bucket of
    each length is ever sorted."""
    plan = stage(mix_plan(lengths, targets), "plan")
    keyed = lengths.withColumn("h", F.xxhash64("doc_id", F.lit(seed))).withColumn("bucket", F.pmod("h", F.lit(BUCKETS)).cast("int"))
    counts = keyed.join(small_side(plan.where("extra > 0").select("source").distinct()), "source").groupBy("source", "n_tokens", "bucket").agg(F.count(F.lit(1)).alias("c"))
    before = F.coalesce(F.sum("c").over(Window.partitionBy("source", "n_tokens").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cut = (
        counts.withColumn("before", before).join(plan.where("extra > 0").select("source", "n_tokens", "extra"), ["source", "n_tokens"])
        .where("before < extra")
    )
    whole = cut.where("before + c <= extra").select("source", "n_tokens", "bucket", F.lit(True).alias("all_in"), F.lit(0).cast("long").alias("room"))
    part = cut.where("before + c > extra").select("source", "n_tokens", "bucket", F.lit(False).alias("all_in"), (F.col("extra") - F.col("before")).alias("room"))
    on = ["source", "n_tokens", "bucket"]
    rank = F.row_number().over(Window.partitionBy(*on).orderBy("h", "doc_id"))
    edge = keyed.join(part, on).withColumn("rank", rank).where("rank <= room").select("doc_id")
    full = keyed.join(whole, on).select("doc_id")
    extra = edge.union(full).groupBy("doc_id").agg(F.count(F.lit(1)).alias("extra_copies"))
    base = plan.select("source", "n_tokens", "whole")
    base = small_side(base)
    return (
        lengths.join(base, ["source", "n_tokens"]).join(extra, "doc_id", "left")
        .select("doc_id", "source", "n_tokens", (F.col("whole") + F.when(F.col("extra_copies").isNotNull(), 1).otherwise(0)).cast("long").alias("copies"))
        .where("copies > 0")
    )
