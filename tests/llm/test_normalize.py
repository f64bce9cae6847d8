import random

import pytest
from hypothesis import given
from hypothesis import strategies as st

from folioforge.llm.normalize import canonical, canonical_column, look_alike_pairs
from pyspark.sql import functions as F

PLAIN = "(A) Café at 5 μm, n = 10 cells, p < 0.05"
ALIKE = [
    "（Ａ） Café at 5 μm, n = 10 cells, p < 0.05",
    "(A) Café at 5 µm, n = 10 cells, p < 0.05",
    "(A) Café at 5 μm, n =　10 ce​l­ls, p < 0.05﻿",
    "(А) Саfé аt 5 μm, n = 10 сеlls, р < 0.05",
]
DIFFERENT = [PLAIN.lower(), PLAIN.replace("é", "e"), PLAIN.replace("10", "1⁰"), PLAIN.replace("μ", "m"), PLAIN.replace(",", ";"), PLAIN.replace("5", "6"), PLAIN.replace(" = ", " – ")]


@pytest.mark.parametrize("text", ALIKE)
def test_alike_texts_have_one_form(text):
    assert text != PLAIN and canonical(text) == canonical(PLAIN)


@pytest.mark.parametrize("text", DIFFERENT)
def test_visible_differences_stay(text):
    assert canonical(text) != canonical(PLAIN)


@pytest.mark.parametrize(("a", "b"), [("α", "a"), ("β", "B"), ("ß", "β"), ("10⁴", "104"), ("½", "1/2"), ("a–b", "a-b"), ("a—b", "a–b"), ("x₂", "x2")])
def test_pairs_that_look_different(a, b):
    assert canonical(a) != canonical(b)


@pytest.mark.parametrize(("a", "b"), [("Å", "Å"), ("℃", "°C"), ("ﬁn", "fin"), ("a‐b", "a-b"), ("a‑b", "a-b"), ("ΑΒΖ", "ABZ"), ("ο", "o"), ("ɡ", "g")])
def test_pairs_that_look_the_same(a, b):
    assert canonical(a) == canonical(b)


def test_genuine_words_of_other_scripts_stay_apart():
    assert canonical("Рисунок") != canonical("Рисунки") and canonical("подписи") == canonical("подписи")


@given(st.text(max_size=40))
def test_idempotent(text):
    once = canonical(text)
    assert canonical(once) == once


def brute(rows):
    return {(g, *sorted((i, j))) for g, i, a in rows for h, j, b in rows if g == h and i < j and a is not None and b is not None and a != b and canonical(a) == canonical(b)}


@pytest.mark.parametrize("rows_per_salt", [3, 20_000])
def test_pairs_against_brute_force(spark, rows_per_salt):
    rng = random.Random(1)
    pool = [PLAIN, *ALIKE, *DIFFERENT, "", " ", " ", "x" * 50_000, None]
    rows = [(rng.choice("fg"), i, rng.choice(pool if i % 3 else [PLAIN, ALIKE[0]])) for i in range(120)]  # a third of all rows in one form
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "field_name string, id bigint, text string, form string, salt int")
    got = {tuple(r) for r in look_alike_pairs(df, "field_name", "id", "text", rows_per_salt).collect()}
    assert got == brute(rows)
    assert look_alike_pairs(df.limit(0), "field_name", "id", "text").count() == 0


def test_column_keeps_nulls_and_folds_on_request(spark):
    df = spark.createDataFrame([(None,), ("Ｓtraße",), ("",)], "t string")
    assert [r[0] for r in df.select(canonical_column(F.col("t"))).collect()] == [None, "Straße", ""]
    assert [r[0] for r in df.select(canonical_column(F.col("t"), True)).collect()] == [None, "strasse", ""]


def test_classes_count_the_pairs(spark):
    from folioforge.llm.normalize import look_alike_classes, look_alike_pairs

    texts = ["caf\u00e9", "cafe\u0301", "caf\u00e9", "cafe", "x", None, "", " ", "\uff58", "x"]
    df = spark.createDataFrame([("g" if i % 10 else "h", i, t, "clash") for i, t in enumerate(texts * 2)], "grp string, id bigint, text string, form string")
    links = {}
    for r in look_alike_pairs(df, "grp", "id", "text").collect():
        for i in (r.id_a, r.id_b):
            links[i] = links.get(i, 0) + 1
    got = look_alike_classes(df, "grp", "id", "text").collect()
    assert {r.id: r.n_links for r in got} == {i: links.get(i, 0) for i, t in enumerate(texts * 2) if t is not None}
    assert all(r.class_id <= r.id for r in got) and look_alike_classes(df.limit(0), "grp", "id", "text").count() == 0
