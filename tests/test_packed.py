"""Several values packed in one field."""

import pytest

from citeloom.operators.packed import resolve_author_skeleton, resolve_citation_skeleton, split_packed

AUTHORS = [
    ("Ann Lee", ["Ann Lee"]),
    ("Lee, Ann", ["Lee, Ann"]),
    ("Lee, Ann and Poe, Bob", ["Lee, Ann", "Poe, Bob"]),
    ("Lee, A., Poe, B.C. and Roe, D.", ["Lee, A.", "Poe, B.C.", "Roe, D."]),
    ("Ann Lee, Bob Poe & Cy Roe", ["Ann Lee", "Bob Poe", "Cy Roe"]),
    ("Lee, Ann;and Poe, Bob", ["Lee, Ann", "Poe, Bob"]),
    ('"Lee, Ann","Poe, Bob"', ["Lee, Ann", "Poe, Bob"]),
    ('"Lee, Ann"; Poe, Bob', ["Lee, Ann", "Poe, Bob"]),
    ("Ann Lee\tBob Poe\tCy Roe", ["Ann Lee", "Bob Poe", "Cy Roe"]),
    ("Ann Lee |Bob Poe", ["Ann Lee", "Bob Poe"]),
    ("Ann Lee / Bob Poe, et al.", ["Ann Lee", "Bob Poe"]),
    ("Lee A, Poe B et al", ["Lee A", "Poe B"]),
    ("Horn Institute of Optics and Acoustics", ["Horn Institute of Optics and Acoustics"]),
    ("Institute of Optics and Acoustics Horn", ["Institute of Optics and Acoustics Horn"]),
    ("Ann Lee and Horn Society for Measures and Records", ["Ann Lee", "Horn Society for Measures and Records"]),
    ("VAN LEE, E.; von Poe, Bob", ["VAN LEE, E.", "von Poe, Bob"]),
    ("et al.", []),
    ("  ", []),
]


def _items(spark, rows, field, kind):
    df = spark.createDataFrame(rows, f"id long, {field} string, pos int, item string")
    got = {}
    for r in split_packed(df, "id", field, kind).collect():
        got.setdefault(r["id"], {})[r["pos"]] = r["item"]
    return {k: [v[i] for i in range(len(v))] for k, v in got.items()}


def test_author_fields(spark):
    # extra columns pos and item clash with the output and must not matter
    rows = [(i, a, 7, "x") for i, (a, _) in enumerate(AUTHORS)] + [(99, None, 1, None)]
    got = _items(spark, rows, "authors", "authors")
    for i, (a, want) in enumerate(AUTHORS):
        assert got.get(i, []) == want, a
    assert 99 not in got


A, B, C = "A. Lee. Title one. In Meeting, 2001.", "B. Poe and C. Roe (2002). Title two. Journal, 3(4):5–6.", "D. Moe. 2003. Title three. Notes 7, pages 8-9."


@pytest.mark.parametrize("sep", ["\n", "\n\n", "\r\n", " ; ", ";", " | ", " • ", " ¶ ", " // "])
def test_citation_separators(spark, sep):
    assert _items(spark, [(1, sep.join((A, B, C)), 0, "")], "raw", "citations") == {1: [A, B, C]}


def test_citation_numbers_quotes_and_wraps(spark):
    wrapped = "A. Lee. 2001.\nTitle one. Journal 5, pages 6-7. doi: 10.5555/x.1999.2"
    rows = [
        (1, f"[7] {A} [8] {B}", 0, ""), (2, f"[7]{A}\n[8]{B}", 0, ""), (3, f'"{A}","{B}"', 0, ""), (4, wrapped, 0, ""), (5, f"(1) {A} (2) {B}", 0, ""),
        (6, f"[3] {A}", 0, ""), (7, wrapped + "\n" + C, 0, ""), (8, "", 0, ""), (9, None, 0, ""),
    ]
    got = _items(spark, rows, "raw", "citations")
    assert got[1] == got[2] == got[3] == got[5] == [A, B]
    assert got[4] == [wrapped] and got[6] == [A] and got[7] == [wrapped, C]
    assert 8 not in got and 9 not in got


def test_repeated_rows_long_texts_and_empty_tables(spark):
    names = [f"Given{chr(97 + i % 26)} Surname{chr(97 + i // 26 % 26)}" for i in range(3000)]
    df = spark.createDataFrame([(1, "; ".join(names)), (2, "Ann Lee; Bob Poe"), (2, "Ann Lee; Bob Poe")], "id long, authors string")
    got = split_packed(df, "id", "authors", "authors").collect()
    assert sum(r["id"] == 1 for r in got) == 3000 and sum(r["id"] == 2 for r in got) == 4
    assert split_packed(df.limit(0), "id", "authors", "authors").count() == 0
    assert split_packed(df.limit(0), "id", "authors", "citations").count() == 0


def test_masks():
    assert resolve_author_skeleton("wcwawcw") == "SJJXSJJ"
    assert resolve_author_skeleton("fcfsf") == "SXSXS"
    assert resolve_citation_skeleton("tYtxtYthtY") == "SJJXSJJXSJ"
    assert resolve_citation_skeleton("tYtht") == "SJJJJ"
