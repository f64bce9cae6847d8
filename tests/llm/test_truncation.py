import math
import random

import numpy as np
import pandas as pd
import pytest

from folioforge.llm.truncation import fit_censored, judge, limits_of

rng = random.Random(21)
NAMES = "Vaburin Zumator Kebemin Tirolin Sodotor Fenaxin Milimetor Repurin Golamin Danelin".split()
TISSUES = "liver heart retina colon spleen kidney muscle cortex thymus ovary".split()


def sentence():
    n, t = rng.choice(NAMES), rng.choice(TISSUES)
    return rng.choice([
        f"Localisation of {n} to nucleoli in control and depleted cells of the {t}.",
        f"Quantification of {n} intensity in {t} sections, n = {rng.randint(3, 12)} animals, paired test.",
        f"Time course of cell adhesion following addition of {n.lower()} at {rng.randint(1, 9)}.{rng.randint(10, 99)} units in {t}.",
        f"Heat map of {n} binding across {rng.randint(10, 999)} regions ranked by signal in the {t}.",
    ])


def caption():
    s = " ".join(sentence() for _ in range(rng.randint(1, 5)))
    return s + f" Same as in ({rng.choice('ABC')}) but for {rng.choice(['VBP', 'KZR', 'TMX'])}{rng.randint(1, 30)} mutants" if rng.random() < 0.15 else s


def made(n=6000):
    rows, cut = [], set()
    for i in range(n):
        source, text = ("web", "mail", "clean")[i % 3], caption()
        if source == "web" and len(text) > 200:
            text = text[:200].rstrip()
            cut.add(i)
        elif source == "mail" and rng.random() < 0.08:
            k = rng.randint(20, max(21, len(text) - 20))
            text = text[:k].rstrip()
            cut.add(i)
        elif source == "clean" and rng.random() < 0.03:
            text = text[:90] + rng.choice(["…", "...", " (more)", "�"])
            cut.add(i)
        rows.append((i, source, text))
    return rows, cut


def test_cut_texts_are_told_from_complete_ones(spark):
    rows, cut = made()
    extra = [(90_001, "web", None), (90_002, None, ""), (90_003, "web", "   "), (90_004, None, "x" * 20_000), (90_005, "clean", "<p>Open <strong>tag</strong> and no end")]
    df = spark.createDataFrame([("t", *r, "clash", 1) for r in rows + extra], "table_name string, row_id bigint, source string, text string, w string, n_chars int")
    got = {r.row_id: r.p_cut > 0.5 for r in judge(df).collect()}
    assert set(got) == {r[0] for r in rows} | {90_004, 90_005} and got[90_005]
    ended = {i for i in cut if rows[i][2].endswith(".") and not rows[i][2].endswith("...")}  # cut exactly where a sentence ends: no sign left
    hits = sum(got[i] for i in cut - ended)
    false = sum(v for i, v in got.items() if i < 90_000 and i not in cut)
    assert hits / len(cut - ended) > 0.95 and false / (hits + false) < 0.05


def test_empty_and_single(spark):
    df = spark.createDataFrame([("t", 1, "s", "A complete sentence stands here.")], "table_name string, row_id bigint, source string, text string")
    assert judge(df.limit(0)).count() == 0
    assert judge(df).first().p_cut < 0.5


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_censored_fit_finds_the_parameters(seed):
    g = np.random.default_rng(seed)
    x = np.exp(g.normal(5.5, 0.6, 20_000))
    seen = x[x < 300]
    mu, sigma = fit_censored(seen, np.ones(len(seen)), np.array([300.0]), np.array([float((x >= 300).sum())]))
    assert math.isclose(mu, 5.5, abs_tol=0.03) and math.isclose(sigma, 0.6, abs_tol=0.03)
    naive = fit_censored(seen, np.ones(len(seen)), np.empty(0), np.empty(0))
    assert naive[0] < 5.4


def test_more_than_eight_limits():
    """A source may have any number of limits, each a pile of open endings."""
    rng = np.random.default_rng(8)
    lengths = np.clip(np.round(rng.lognormal(6, 0.9, 4_000)), 25, 4_000).astype(int)
    limits = [100 + 150 * k for k in range(12)]
    rows = [(n, 1, 0.05, 1) for n in lengths] + [(n, 60, 60.0, 0) for n in limits]
    pdf = pd.DataFrame(rows, columns=["n_chars", "n", "n_open", "n_ended"]).groupby("n_chars", as_index=False).sum()
    pdf = pdf.assign(table_name="t", source="s", n_bytes=pdf["n_chars"] + 7)
    got = limits_of(pdf)
    assert {a - 7 if u == "n_bytes" else a for u, a in zip(got.iloc[:, 2], got.iloc[:, 3])} == set(limits)


def test_long_words_and_long_sentences(spark):
    """Words beyond the plain length are told apart, stretches lose no word, and nothing grows beyond the text."""
    from pyspark.sql import functions as F

    from folioforge.llm.truncation import STRETCH, contexts

    long_words = ["x" * 40 + "a", "x" * 40 + "b"]
    sentence = [f"w{i}" for i in range(3 * STRETCH + 5)]
    df = spark.createDataFrame([([sentence, long_words * 2],)], "sentences array<array<string>>")
    got = contexts(df).collect()
    assert sum(r.n for r in got) == len(sentence) + 4 and sum(r.followed for r in got) == len(sentence) + 3
    assert {(r.p2, r.p1, r.w) for r in got if r.w in sentence[2:]} == set(zip(sentence, sentence[1:], sentence[2:]))
    assert len({r.p1 for r in got if r.w in long_words}) == 3  # none, and each of the two
    rows = [("t", i, "s", t) for i, t in enumerate(["y" * 100_000, "The " + "word " * 20_000, "The end is here.", " "])]
    judged = judge(spark.createDataFrame(rows, "table_name string, row_id bigint, source string, text string")).agg(F.count("*")).first()[0]
    assert judged == 3


def test_marks_are_evidence_of_the_model(spark):
    rows = [("t", i, "s", f"The cells of line {i} grew in the dark.") for i in range(40)] + [("t", 90, "s", "The cells of line 7 gr…"), ("t", 91, "s", "The cells of <b>line 7 grew in the dark.")]
    got = {r.row_id: r.p_cut for r in judge(spark.createDataFrame(rows, "table_name string, row_id bigint, source string, text string")).collect()}
    assert all(0.9 < got[i] < 1 for i in (90, 91)) and all(got[i] < 0.5 for i in range(40))


def test_any_number_of_limits():
    rng = np.random.default_rng(3)
    limits = [90 + 23 * k for k in range(12)]
    lengths = [*rng.integers(30, 600, 4000), *np.repeat(limits, 120)]
    pdf = pd.DataFrame({"n_chars": lengths, "n_bytes": [int(x) + int(y) for x, y in zip(lengths, rng.integers(1, 60, len(lengths)))]})
    pdf["n_open"] = [0.02] * 4000 + [0.95] * (120 * 12)
    pdf = pdf.groupby(["n_chars", "n_bytes"]).agg(n=("n_open", "size"), n_open=("n_open", "sum")).reset_index().assign(n_ended=0, table_name="t", source="s")
    assert {r.size_limit for r in limits_of(pdf).itertuples() if r.unit == "n_chars"} == set(limits)
