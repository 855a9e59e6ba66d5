"""Problems 4 and 10 against brute force."""

import random
import re
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

pytest.importorskip("citeloom.llm")

from citeloom.llm import batches, spans  # noqa: E402
from citeloom.llm.batches import HistoryIndex, batch_pairs, block_tables, fingerprint_documents, id_ranges, near_classes, shingle_hashes  # noqa: E402


def _words(rng, n):
    return [f"w{rng.randrange(3000)}" for _ in range(n)]


def _corpus():
    rng = random.Random(5)
    rows, k = [], 0
    for b in range(12):
        base = _words(rng, 120)
        for c in range(4):
            w = list(base)
            for _ in range(c * 5):
                w[rng.randrange(len(w))] = f"z{rng.randrange(9999)}"
            rows.append((k, " ".join(w) if c % 2 else ", ".join(w).upper() + ".", (b + c) % 3))
            k += 1
    rows += [(200 + i, " ".join(_words(rng, 60)), i % 3) for i in range(20)]
    rows += [(300, None, 0), (301, "", 1), (302, "two words", 2), (303, "two words", 1), (304, rows[0][1], None), (305, rows[0][1], 2), (306, rows[0][1], 2)]
    return rows


def _similar(rows):
    sets = {}
    for i, t, b in rows:
        w = re.findall(r"[^\W_]+", (t or "").lower())
        s = {tuple(w[j : j + 3]) for j in range(len(w) - 2)}
        if s and b is not None:
            sets[i] = (s, b)
    return {(a, b) for a, b in combinations(sorted(sets), 2) if sets[a][1] != sets[b][1] and 2 * len(sets[a][0] & sets[b][0]) >= len(sets[a][0] | sets[b][0])}


def test_batches_against_brute_force(spark):
    rows = _corpus()
    df = spark.createDataFrame([(*r, "rep", b"fp") for r in rows], "doc_id long, text string, batch_no int, rep string, fp binary")
    assert {tuple(r) for r in batch_pairs(df).collect()} == _similar(rows)
    classes = {r["doc_id"]: r for r in near_classes(df).collect()}
    assert set(classes) == {i for i, t, b in rows if t and len(t.split()) > 2 and b is not None} and classes[305]["class_id"] == classes[0]["class_id"]
    assert batch_pairs(df.limit(0)).count() == 0


def test_history_index(spark, tmp_path):
    rows = _corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string, batch_no int")
    path = f"file://{tmp_path}/index"
    for b in (0, 1, 2):
        index = HistoryIndex(spark, path)  # as a new session finds it
        fps = fingerprint_documents(df.where(f"batch_no = {b}"))
        if b == 1:  # an attempt that failed before its commit
            with pytest.MonkeyPatch.context() as m:
                m.setattr(HistoryIndex, "_mark", lambda *a: 1 / 0)
                with pytest.raises(ZeroDivisionError):
                    index.accept(b, fps, df)
            assert "1" not in index.attempts()
        index.accept(b, fps, df)
        before = index.table("members").count()
        index.accept(b, fps, df)
        assert index.table("members").count() == before
    reps = {r["doc_id"]: (r["rep"], r["batch_no"]) for r in index.table("members").collect()}
    links = {(r["a"], r["b"]) for r in index.table("links").collect()}
    found = {(x, y) for x in reps for y in reps if x < y and reps[x][1] != reps[y][1] and (reps[x][0] == reps[y][0] or tuple(sorted((reps[x][0], reps[y][0]))) in links)}
    assert found == _similar(rows)


def test_lookup_does_not_move_history(spark, tmp_path):
    df = spark.createDataFrame(_corpus(), "doc_id long, text string, batch_no int")
    index = HistoryIndex(spark, f"file://{tmp_path}/index")
    index.accept(0, fingerprint_documents(df.where("batch_no = 0")), df)
    blocks = spark.table(index._blocks)
    new = block_tables(fingerprint_documents(df.where("batch_no = 1"))).repartition(8, "block")
    plan = blocks.join(new.select("block").hint("shuffle_hash"), "block", "left_semi")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "ShuffledHashJoin" in plan


def test_id_ranges(spark):
    df = spark.createDataFrame([(i,) for i in [*range(0, 100), *range(5000, 5100), 10**9]], "id long")
    assert id_ranges(df, 0, 10**9, 3) == [(0, 5099), (10**9, 10**9)] and id_ranges(df.where("id < 9999"), 0, 5099, 2) == [(0, 99), (5000, 5099)]
    assert id_ranges(df.limit(0), None, None) == []


def test_blocks_find_pairs_at_one_half():
    """Simulated lanes of pairs at similarity 0.5, through the block tables and the Hamming distance."""
    rng, n = np.random.default_rng(3), 40_000
    lost = 0
    for _ in range(n // 2_000):
        a = rng.integers(0, 2**16, (2_000, batches.LANES), dtype=np.uint16)
        b = np.where(rng.random(a.shape) < 0.5, a, rng.integers(0, 2**16, a.shape, dtype=np.uint16))
        keys = []
        for x in (a, b):
            rb = pa.RecordBatch.from_arrays([pa.array(range(2_000), pa.int64()), pa.array([r.tobytes() for r in x], pa.binary())], names=["doc_id", "fp"])
            keys.append(next(batches._blocks(iter([rb]))).column(0).to_numpy().reshape(2_000, -1))
        near = np.bitwise_count(a ^ b).sum(axis=1) <= batches.MAX_BITS
        lost += int((~((keys[0] == keys[1]).any(axis=1) & near)).sum())
    assert lost / n < 0.0005


def test_shingles_are_the_word_sequences():
    h, n = shingle_hashes(["a b c d", "", "b c d", "a"], 3)
    assert n.tolist() == [2, 0, 1, 0] and h[1] == h[2] != h[0]


def _brute_spans(rows, w):
    own, out = {}, set()
    for i, t in rows:
        for k in range(len(t) - w + 1):
            own.setdefault(t[k : k + w], set()).add(i)
    for i, t in rows:
        run = None
        for k in range(len(t) - w + 1):
            if len(own[t[k : k + w]]) > 1:
                if run and k <= run[1]:
                    run[1] = k + w
                else:
                    if run:
                        out.add((i, *run))
                    run = [k, k + w]
        if run:
            out.add((i, *run))
    return out


@pytest.mark.parametrize("cap", [4096, 2])  # 2: every tree is too large and its windows are counted
def test_spans_against_brute_force(spark, monkeypatch, cap):
    monkeypatch.setattr(spans, "MAX_TREE", cap)
    rng = random.Random(11)
    text = lambda n: "".join(rng.choice("abcdefghij klmnop") for _ in range(n))
    shared = [text(n) for n in (299, 300, 301, 700)]
    rows = [(i, text(rng.randrange(0, 200)) + s + text(rng.randrange(0, 200))) for i, s in enumerate(shared * 3)]
    rows += [(50, text(100) + shared[3][50:400] + text(50) + shared[3][300:650]), (51, "é" * 400), (52, "é" * 900), (53, text(500)), (60, rows[1][1]), (61, rows[1][1]), (62, "xy" * 400), (63, "short"), (64, "short"), (65, "")]
    df = spark.createDataFrame([(*r, 1) for r in rows] + [(70, None, 1), (53, rows[15][1], 1)], "doc_id long, text string, first int")
    assert {tuple(r) for r in spans.shared_spans(df).collect()} == _brute_spans(rows, 300)
    assert spans.shared_spans(df.limit(0)).count() == 0


def test_large_partition_of_few_contexts(spark, monkeypatch):
    monkeypatch.setattr(spans, "MAX_TREE", 4)
    rng = random.Random(3)
    text = lambda n: "".join(rng.choice("abcdefghij klmnop") for _ in range(n))
    shared = text(1500)  # more places than a tree holds, with equal contexts
    rows = [(i, text(50) + shared + text(50)) for i in range(6)]
    got = {tuple(r) for r in spans.shared_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == _brute_spans(rows, 300)
