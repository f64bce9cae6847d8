import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from folioforge.llm.packing import best_fit, encoding, pack, pack_texts


def brute_best_fit(sizes, capacity):
    fill, out = [], []
    for s in sizes:
        fits = [(capacity - f, i) for i, f in enumerate(fill) if f + s <= capacity]
        if fits:
            i = min(fits)[1]
        else:
            fill.append(0)
            i = len(fill) - 1
        fill[i] += s
        out.append(fill[i] - s)
    return sorted(fill)


def test_best_fit_fills_like_brute_force():
    rng = random.Random(4)
    for _ in range(30):
        sizes = [rng.randint(0, 20) for _ in range(60)]
        fill = defaultdict(int)
        for b, s in zip(best_fit(sizes, 20), sizes):
            fill[b] += s
        assert sorted(fill.values()) == brute_best_fit(sizes, 20) and max(fill.values()) <= 20


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_all_items_are_packed_within_capacity(spark, parts):
    rng = random.Random(7)
    rows = [(str(i), rng.choice([0, 1, 50, 90, 100, rng.randint(1, 100)])) for i in range(1000)]
    df = spark.createDataFrame(rows, "item string, size bigint").repartition(parts)
    got = pack(df, 100, fan_in=4).collect()
    assert sorted((r.item, r["size"]) for r in got) == sorted(rows)
    fill = defaultdict(int)
    for r in got:
        fill[r.bin] += r["size"]
    assert max(fill.values()) <= 100 and all(fill[r.bin] == r.fill for r in got)
    best = sum(s for _, s in rows) / 100
    assert len(fill) < 1.06 * best + 2


def test_items_that_never_share_a_bin(spark):
    df = spark.range(200).select(F.col("id").cast("string").alias("item"), F.lit(60).cast("bigint").alias("size")).repartition(20)
    assert pack(df, 100, bins_per_task=30).select("bin").distinct().count() == 200


def test_texts(spark):
    long = "word " * 500
    rows = [(1, "a b c"), (2, None), (3, ""), (4, long), (5, "a b c"), (6, "x" * 3000), (7, "<|endoftext|>")]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id bigint, text string, item string, size int")
    got = pack_texts(df, "doc_id", "text", 128).collect()
    tokens = defaultdict(int)
    for r in got:
        tokens[r.doc_id] += r.n_tokens
    assert dict(tokens) == {i: len(encoding().encode_ordinary(t or "")) for i, t in rows}
    fill = defaultdict(int)
    for r in got:
        fill[r.container] += r.n_tokens
    assert max(fill.values()) <= 128
    parts = {i: sorted(r.part_no for r in got if r.doc_id == i) for i, _ in rows}
    for i, _ in rows:
        assert parts[i] == list(range(1, max(1, -(-tokens[i] // 128)) + 1))
        assert all(r.n_tokens == 128 for r in got if r.doc_id == i and r.part_no < len(parts[i]))
    assert pack_texts(df.limit(0), "doc_id", "text", 128).count() == 0


def test_documents_use_the_space(spark, small_data):
    from folioforge.llm.queries import p6_usage

    r = p6_usage(spark, small_data).first()
    assert r.share_used > 0.95
