import itertools
import random

import numpy as np
import pytest

from folioforge.llm import leakage
from folioforge.llm.leakage import MASKS, OVERLAP_MASKS, RUN, compare, find_leaks, seeds, word_ids, word_lists


def test_words():
    assert word_lists("<p>BW-48 <em>cells</em>,\nta&amp;ke UP</p>") == [["bw", "48", "cells", "ta", "ke", "up"]]
    assert word_lists("pefo-\nmycin now") == [["pefomycin", "now"], ["pefo", "mycin", "now"]]
    assert ["substrate", "x"] in word_lists("sub<em>strate</em> x") and ["sub", "strate", "x"] in word_lists("sub<em>strate</em> x")
    assert word_lists(None) == [] and word_lists("") == []


def test_masks_suit_the_run():
    assert all(len(m) == RUN == 10 and m[0] == m[-1] == "1" and "0" in m for m in MASKS)
    ids = word_ids([f"w{i}" for i in range(30)])
    other = ids.copy()
    other[[7, 17]] = word_ids(["x", "y"])
    for m in MASKS:
        assert len(seeds(ids, m)) == 21 and len(seeds(ids[:9], m)) == 0
    assert (seeds(ids, MASKS[0]) == seeds(other, MASKS[0])).any()


def test_compare():
    a = word_ids(list("abcdefghijklmnopqrstuvwxyz"))
    b = a[3:20].copy()
    b[8] = word_ids(["!"])[0]
    assert compare(a, b, 3) == (8, 17, 1)
    assert compare(a, np.empty(0, np.uint64), 0) == (0, 0, 0)


def brute(docs, items):
    runs = {}
    for i, p in items:
        for w in word_lists(p):
            for k in range(len(w) - RUN + 1):
                runs.setdefault(tuple(w[k : k + RUN]), set()).add(i)
    return {(d, i) for d, t in docs for w in word_lists(t) for k in range(len(w) - RUN + 1) for i in runs.get(tuple(w[k : k + RUN]), ())}


@pytest.mark.parametrize("most_seeds", [10**9, 0])
def test_runs_of_ten_words_against_brute_force(spark, most_seeds):
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([5, 9, 10, 30])))) for i in range(20)] + [(98, None), (99, "")]
    docs = [(0, None), (1, ""), (2, "short text")]
    for d in range(3, 80):
        words = rng.choices(vocabulary, k=40)
        if d % 3:
            i, p = rng.choice(items[:20])
            w = p.split()
            n = rng.choice([9, 10, 11, 25])
            words[5:5] = [x.upper() + rng.choice([",", "-\n", "</em>", ""]) for x in w[:n]]
        docs.append((d, " ".join(words)))
    docs.append((80, docs[79][1]))
    df = spark.createDataFrame([(*r, "clash", 3) for r in docs], "doc_id bigint, text string, passage string, item_id int")
    ask = spark.createDataFrame([(*r, "clash") for r in items], "item_id bigint, passage string, text string")
    got = {(r.doc_id, r.item_id) for r in find_leaks(df, ask, most_seeds=most_seeds).where(f"longest_run >= {RUN}").collect()}
    assert got == brute(docs, items) and len(got) > 10
    assert find_leaks(df.limit(0), ask, most_seeds=most_seeds).count() == 0
    assert find_leaks(df, ask.limit(0), most_seeds=most_seeds).count() == 0


def test_substitutions_are_tolerated(spark):
    w = [f"w{i}" for i in range(40)]
    changed = [x if i % 9 else "other" for i, x in enumerate(w)]
    df = spark.createDataFrame([(1, " ".join(changed))], "doc_id bigint, text string")
    r = find_leaks(df, spark.createDataFrame([(7, " ".join(w))], "item_id bigint, passage string")).first()
    assert r.longest_run < RUN and r.overlap_words >= 30 and 0 < r.substituted * 5 <= r.overlap_words


def longest_overlap(bits):
    """By trying all stretches."""
    fits = [(j - i, bits[i:j].count(False)) for i in range(len(bits)) for j in range(i + 1, len(bits) + 1) if bits[i] and bits[j - 1] and bits[i:j].count(False) * 5 <= j - i]
    return max((n for n, _ in fits), default=0)


def test_longest_overlap_against_all_stretches():
    rng = random.Random(5)
    for _ in range(400):
        bits = [rng.random() < rng.choice([0.5, 0.75, 0.9]) for _ in range(rng.randint(1, 30))]
        words = np.array([0 if b else 1 for b in bits], np.uint64)
        run, n, unequal = compare(words, np.zeros(len(bits), np.uint64), 0)
        assert n == longest_overlap(bits) and unequal * 5 <= n
        assert run == max((len(list(g)) for k, g in itertools.groupby(bits) if k), default=0)


@pytest.mark.parametrize("n", range(10, 17))
def test_share_of_substituted_overlaps_that_hold_a_seed(n):
    """All ways to substitute as many words of n as may be."""
    hits = [(len(m), [k for k, b in enumerate(m) if b == "1"]) for m in OVERLAP_MASKS]
    met = []
    for off in itertools.combinations(range(n), n // 5):
        met.append(any(not {p + k for k in at}.intersection(off) for size, at in hits for p in range(n - size + 1)))
    assert sum(met) / len(met) >= 0.998


@pytest.mark.parametrize(("n", "k"), [(15, 2), (15, 3), (20, 3), (20, 4), (25, 5), (30, 6), (50, 10)])
@pytest.mark.parametrize("most_seeds", [10**9, 0])
def test_recall_by_length_and_substitutions(spark, n, k, most_seeds):
    rng = random.Random(n * 100 + k)
    passage = [f"p{i}" for i in range(n)]
    docs = []
    for d in range(150):
        words = list(passage)
        for i in rng.sample(range(n), k):
            words[i] = f"q{d}x{i}"
        docs.append((d, " ".join(["a", "b", *words, "c"])))
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    ask = spark.createDataFrame([(1, " ".join(passage))], "item_id bigint, passage string")
    got = find_leaks(df, ask, most_seeds=most_seeds, masks=OVERLAP_MASKS).where(f"overlap_words >= {RUN}").count()
    # words substituted at an end shorten the overlap, below ten at times for the shortest
    want = sum(longest_overlap([a == b for a, b in zip(t.split()[2:], passage)]) >= RUN for _, t in docs)
    assert want >= 100 and got >= 0.99 * want


@pytest.mark.parametrize("most_seeds", [10**9, 0])
def test_neighbouring_changed_words_are_found(spark, most_seeds):
    p = [f"p{i}" for i in range(20)]
    docs = [(1, ["a", *p[:9], "x", "y", *p[11:], "b"]), (2, [*p[:5], "x", *p[6:11]]), (3, [*p[:5], "x", "y", *p[7:11]])]
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in docs], "doc_id bigint, text string")
    ask = spark.createDataFrame([(7, " ".join(p))], "item_id bigint, passage string")
    got = find_leaks(df, ask, most_seeds=most_seeds, masks=OVERLAP_MASKS).where(f"overlap_words >= {RUN}").collect()
    assert {(r.doc_id, r.longest_run, r.overlap_words, r.substituted) for r in got} == {(1, 9, 20, 2), (2, 5, 11, 1), (3, 5, 11, 2)}


@pytest.mark.parametrize("most_seeds", [10**9, 0])
def test_run_and_overlap_of_different_readings(spark, most_seeds):
    """With the words joined at line ends the best overlap, without that the longest run."""
    w, v = [f"w{i}" for i in range(17)], [f"v{i}" for i in range(8)]
    doc = " ".join([*w[:8], "x-\ny", *w[9:], "z", "z", *v, "foo-\nbar"])
    ask = spark.createDataFrame([(7, " ".join([*w, *v, "foo"]))], "item_id bigint, passage string")
    r = find_leaks(spark.createDataFrame([(1, doc)], "doc_id bigint, text string"), ask, most_seeds=most_seeds, masks=OVERLAP_MASKS).first()
    assert (r.longest_run, r.overlap_words, r.substituted) == (9, 17, 1)


def test_documents_with_many_passages_are_compared_in_parts(spark, monkeypatch):
    monkeypatch.setattr(leakage, "PASSAGES_PER_ROW", 3)
    passages = [(i, " ".join(f"w{i}x{k}" for k in range(12))) for i in range(25)]
    df = spark.createDataFrame([(1, " and ".join(p for _, p in passages)), (2, passages[3][1]), (3, "none of them")], "doc_id bigint, text string")
    got = {(r.doc_id, r.item_id) for r in find_leaks(df, spark.createDataFrame(passages, "item_id bigint, passage string"), most_seeds=0).collect()}
    assert got == {(1, i) for i in range(25)} | {(2, 3)}
