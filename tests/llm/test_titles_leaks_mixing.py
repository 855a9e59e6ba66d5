"""Problems 1, 8 and 9 against brute force and on awkward input."""

import itertools
import random
import re
from collections import defaultdict

import pytest

pytest.importorskip("citeloom.llm")

from pyspark.sql import functions as F  # noqa: E402

from citeloom.llm import leakage, titles  # noqa: E402
from citeloom.llm.leakage import find_leaks  # noqa: E402
from citeloom.llm.mixing import fit_budget, mix_documents, mix_report, token_lengths  # noqa: E402
from citeloom.llm.titles import collapse_titles  # noqa: E402


def test_titles_against_brute_force(spark):
    rng = random.Random(1)
    words = ["alpha", "beta", "gamma", "Δelta", "naïve", "x2"]
    rows = []
    for i in range(400):
        t = [rng.choice(words) for _ in range(rng.randrange(0, 4))]
        t = [w.upper() if rng.random() < 0.3 else w for w in t]
        rows.append((rng.choice("ab"), i, rng.choice([" ", ": ", "  -", ", "]).join(t) + rng.choice(["", ".", "!"]), "c", 1))
    rows += [("a", 900, None, "c", 1), ("a", 901, "?!", "c", 1), ("b", 902, "", "c", 1), ("a", 5000, "hot title", "c", 1)] + [("a", 5000 + i, "Title, HOT", "c", 1) for i in range(1, 300)]
    df = spark.createDataFrame(rows, "tbl string, k long, title string, canonical string, copies int")
    got = {(r["scope"], r["key"]): (r["first_key"], r["copies"]) for r in collapse_titles(df, "tbl", "k", "title").collect()}
    groups = defaultdict(list)
    for tbl, k, t, *_ in rows:
        w = sorted(re.findall(r"[^\W_]+", (t or "").lower()))
        if w:
            groups[tbl, *w].append(k)
    assert got == {(g[0], k): (min(ks), len(ks)) for g, ks in groups.items() for k in ks}
    assert collapse_titles(df.limit(0), "tbl", "k", "title").count() == 0


ITEM = " ".join(f"w{i}" for i in range(30))


def _leaks(spark, docs, items):
    d = spark.createDataFrame(docs, "doc_id long, text string, item_id long, words int")
    i = spark.createDataFrame(items, "item_id long, text string, doc_id string")
    return {(r["doc_id"], r["item_id"]): (r["words"], r["first_char"], r["last_char"]) for r in find_leaks(d, i).collect()}


def test_leaks(spark):
    part = " ".join(f"w{i}" for i in range(5, 18))
    docs = [
        (1, f"Intro! {ITEM.replace(' ', ',' + chr(10)).upper()} end", 0, 0), (2, "x " + part, 0, 0), (3, part[3:], 0, 0), (4, None, 0, 0), (5, "", 0, 0), (None, ITEM, 0, 0),
        (6, "w4x " + part.replace("w17", "w177"), 0, 0), (7, "a " * 200_000 + part, 0, 0),
    ]
    got = _leaks(spark, docs, [(9, ITEM, "z"), (10, "too short", "z"), (11, None, "z"), (None, ITEM, "z")])
    assert set(got) == {(1, 9), (2, 9), (7, 9)} and got[2, 9][0] == 13 and got[1, 9][0] == 30
    text = docs[0][1]
    assert text[got[1, 9][1] : got[1, 9][2]].lower().startswith("w0") and text[got[1, 9][1] : got[1, 9][2]].endswith("W29")
    assert _leaks(spark, docs, [(10, "too short", "z")]) == {}
    assert find_leaks(spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")).count() == 0


def test_fit_budget_is_as_near_as_can_be():
    rng = random.Random(3)
    for _ in range(200):
        lengths = rng.sample(range(1, 40), 4)
        counts = [rng.randrange(0, 4) for _ in lengths]
        budget = rng.randrange(0, 200)
        take = fit_budget(lengths, counts, budget)
        assert all(0 <= take.get(n, 0) <= c for n, c in zip(lengths, counts))
        best = max(s for s in (sum(n * k for n, k in zip(lengths, ks)) for ks in itertools.product(*(range(c + 1) for c in counts))) if s <= budget)
        assert sum(n * k for n, k in take.items()) == best


def test_mix(spark):
    docs = [(i, "word " * (5 + i % 7), "big" if i % 4 else "small") for i in range(200)] + [(900, "word " * 50, None), (901, None, "big"), (902, "", "big")]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    targets = spark.createDataFrame([("big", 0.5, 1), ("small", 0.4, 2), ("none", 0.05, 3), (None, 0.1, 1)], "source string, target_share double, max_repeats int")
    lengths = token_lengths(df).cache()
    report = {r["source"]: r for r in mix_report(lengths, targets).collect()}
    total = sum(r["n_tokens"] for r in lengths.collect())
    assert set(report) == {"big", "small", "none"} and not report["none"]["reachable"] and report["big"]["reachable"]
    assert report["small"]["reachable"] == (report["small"]["tokens"] * 2 >= 0.4 * total)
    assert 0 <= int(0.5 * total) - report["big"]["mixed_tokens"] <= 3
    mix = mix_documents(lengths, targets).collect()
    assert sum(r["n_tokens"] * r["copies"] for r in mix if r["source"] == "big") == report["big"]["mixed_tokens"]
    assert all(r["copies"] <= {"big": 1, "small": 2}[r["source"]] for r in mix) and len({r["doc_id"] for r in mix}) == len(mix)
    assert sorted(map(tuple, mix_documents(lengths, targets).collect())) == sorted(map(tuple, mix))
    assert mix_report(lengths.limit(0), targets).where("reachable and target_share > 0").count() in (0, 3)


@pytest.mark.parametrize("rows", [30_000, 120_000])
def test_filters_grow_with_the_rows(spark, monkeypatch, rows):
    """With ranges of 8 KB each the part of the unique rows that is let through stays the same."""
    monkeypatch.setattr(titles, "RANGE_BITS", 1 << 16)
    monkeypatch.setattr(titles, "SEGMENT_BITS", 1 << 14)
    assert titles.filter_size(rows)[0] >= rows * 16 // (1 << 16)
    df = spark.range(rows, numPartitions=6).select(F.xxhash64("id").alias("h"), "id")
    df = df.unionByName(df.where("id % 500 = 7")).repartition(6)
    marked = titles.mark_repeats(df, "h", rows, "id")
    assert marked.count() == df.count() and marked.where("id % 500 = 7 and not maybe").count() == 0
    assert marked.where("maybe and id % 500 <> 7").count() < 0.02 * rows


def test_leaks_in_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(leakage, "MAX_BLOCK_CHARS", 50)
    monkeypatch.setattr(leakage, "BUFFER_CHARS", 300)
    rng = random.Random(8)
    word = lambda: rng.choice("abcd")
    items = [(i, " ".join(word() + str(rng.randrange(9)) for _ in range(rng.randrange(5, 40)))) for i in range(30)]
    docs = [(i, " ".join(items[rng.randrange(30)][1].split()[rng.randrange(4) :][: rng.randrange(10, 30)] + [word() * 2] * 3 + items[i % 30][1].split()[: rng.randrange(20)])) for i in range(120)]
    grams = lambda t: {tuple(w) for w in zip(*(t.split()[k:] for k in range(13)))}
    want = {(d, i) for d, t in docs for i, x in items if grams(t) & grams(x)}
    d = spark.createDataFrame(docs, "doc_id long, text string")
    found = find_leaks(d, spark.createDataFrame(items, "item_id long, text string"))
    assert {(r["doc_id"], r["item_id"]) for r in found.collect()} == want and len(want) > 50
    assert str(found._jdf.queryExecution().executedPlan()).count("Scan") == 1


def test_reachable_comes_from_the_plan(spark):
    df = spark.createDataFrame([(1, "a b c", "x")], "doc_id long, text string, source string")
    short = mix_report(token_lengths(df), spark.createDataFrame([("x", 0.9, 1), ("y", 0.1, 2)], "source string, target_share double, max_repeats int")).where("not reachable").select("source")
    assert "FlatMapGroupsInPandas" in short._jdf.queryExecution().executedPlan().toString() and [r[0] for r in short.collect()] == ["y"]
