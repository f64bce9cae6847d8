import random

import pytest
from pyspark.sql import functions as F

from folioforge.operators import chunking, dedup, linkage, model, rollup
from folioforge.operators.partitioning import salt_count, spread
from folioforge.streaming import events as streams


def test_keep_best_takes_the_first_of_equals(spark):
    rows = [(1, "A", 5, 1), (1, "A", 5, 2), (1, "A", None, 0), (1, "B", None, 3), (None, "A", 1, 4)]
    df = spark.createDataFrame(rows, "g int, l string, s int, o int")
    got = {(r.g, r.l): (r.o, r.place) for r in dedup.keep_best(df, ["g", "l"], F.col("s"), F.col("o"), "place").collect()}
    assert got == {(1, "A"): (1, 0), (1, "B"): (3, 3), (None, "A"): (4, 4)}
    assert dedup.keep_best(df.limit(0), ["g"], F.col("s"), F.col("o")).count() == 0


def test_first_and_rest_with_null_keys(spark):
    df = spark.createDataFrame([(None, 2), (None, 1), ("x", 3), ("x", 4)], "k string, o int")
    assert sorted((r.o, r.is_first) for r in dedup.first_and_rest(df, ["k"], "o").collect()) == [(1, True), (2, False), (3, True), (4, False)]


def brute_labels(used, n):
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    names = [x for x in [*letters, *(a + b for a in letters for b in letters)] if x not in used]
    return (names + ["unknown"] * n)[:n]


@pytest.mark.parametrize(("used", "n"), [(["A", "c"], 3), ([], 30), (["A"], 702), (["b", " a "], 1)])
def test_free_labels(spark, used, n):
    rows = [(1, k, u) for k, u in enumerate(used)] + [(1, 100 + k, random.choice([None, "", "  "])) for k in range(n)]
    got = dedup.free_labels(spark.createDataFrame(rows, "g int, o int, l string"), "g", "o", "l").orderBy("o").collect()
    assert [r.new_label for r in got] == brute_labels({u.strip().upper() for u in used}, n)


def test_gaps(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (1, 5), (1, 5), (2, 3), (3, None)], "g int, n int")
    assert [tuple(r) for r in dedup.gaps(df, "g", "n").collect()] == [(1, 3, 4)]


def test_contained(spark):
    extracts = spark.createDataFrame([(1, "m", "bc"), (2, "m", ""), (3, "m", None), (4, "n", "x"), (5, None, "x")], "i int, k string, e string")
    sources = spark.createDataFrame([("m", "abcd")], "k string, s string")
    got = {r.i: r.is_verbatim for r in linkage.contained(extracts, sources, "k", "e", "s").collect()}
    assert got == {1: True, 2: False, 3: False, 4: False, 5: False}


def test_contained_in_any_source_of_the_key(spark, monkeypatch):
    monkeypatch.setattr(linkage.meet, "__defaults__", (2,))  # every key is hot
    rng = random.Random(4)
    word = lambda n: "".join(rng.choice("abc") for _ in range(n))
    rows = [(i, rng.choice(["m", "n", "o", None]), rng.choice([None, "", word(3), word(4)])) for i in range(80)]
    texts = [(rng.choice(["m", "n", None]), rng.choice([None, word(8)])) for _ in range(30)]
    got = linkage.contained_in_any(spark.createDataFrame(rows, "i int, k string, e string"), spark.createDataFrame(texts, "k string, s string"), "k", "e", "s").collect()
    want = {i: bool(k and e and any(q == k and s and e in s for q, s in texts)) for i, k, e in rows}
    assert len(got) == len(rows) and {r.i: r.is_verbatim for r in got} == want
    assert 0 < sum(want.values()) < len(rows)


def test_verbatim_in_an_older_section(spark, tmp_path):
    """A caption that stands in an older section row only is verbatim in some section."""
    from folioforge.plans import registry

    sections = spark.createDataFrame([(1, "m", "Old <b>Cells</b> here", 1), (2, "m", "new text", 2)], "section_id long, manuscript_id string, figure_legends string, t long")
    sections.selectExpr("section_id", "manuscript_id", "figure_legends", "timestamp_seconds(t) AS extracted_at").write.parquet(str(tmp_path / "extracted_sections.parquet"))
    panels = spark.createDataFrame([(1, "m", "a", "cells"), (2, "m", "a", "new"), (3, "m", "a", "none"), (4, "n", "a", "new")], "panel_info_id long, manuscript_id string, source string, panel_caption string")
    panels.write.parquet(str(tmp_path / "panel_info.parquet"))
    got = registry.QUERIES["q05b_verbatim_any_section"](spark, str(tmp_path)).collect()
    assert {r.panel_info_id: r.is_verbatim for r in got} == {1: True, 2: True, 3: False, 4: False}
    assert [tuple(r) for r in registry.QUERIES["q06b_hallucination_any_section"](spark, str(tmp_path)).collect()] == [("a", 4, 2.0)]


def test_pair_accuracy_matches_names_in_part(spark, monkeypatch):
    """Against all pairs, as the reference counts them."""
    rng = random.Random(6)
    names = ["GEO", "geo", "NCBI GEO", "ncbi", "BioStudies", ""]
    rows = [(rng.choice("pqr"), rng.random() < 0.4, rng.choice(names), rng.choice(["x", "y", None]), rng.choice(["u", None])) for _ in range(60)]
    rows += [("s", True, "GEO", "x", "u"), ("s", False, "NCBI Geo", "y", "v"), ("t", False, "GEO", "x", "u"), ("v", True, "GEO", "x", "u")]
    want = {}
    for k in "pqrstv":
        e, a = [r for r in rows if r[0] == k and r[1]], [r for r in rows if r[0] == k and not r[1]]
        hits = sum((x[2].lower() in y[2].lower() or y[2].lower() in x[2].lower()) + (x[3] == y[3]) + (x[4] == y[4]) for x in e for y in a)
        want[k] = pytest.approx(hits / 3 / max(len(e), 1))
    df = spark.createDataFrame(rows, "k string, e boolean, d string, n string, u string")
    for rows_a_task in (1_000, 2):
        monkeypatch.setattr(linkage.meet, "__defaults__", (rows_a_task,))
        assert {r.k: r.accuracy for r in linkage.pair_accuracy(df, "k", "e", "d", ["n", "u"]).collect()} == want
    assert want["s"] == 1 / 3


def test_expected_labels(spark, tmp_path):
    """A third panel passes, and a key without a list keeps all rows."""
    from folioforge.plans import registry

    panels = [(1, 1, "x"), (1, 2, "y"), (1, 3, "a"), (1, 4, None), (2, 5, "x"), (2, 6, None), (None, 7, "x")]
    spark.createDataFrame(panels, "caption_id long, panel_id long, panel_label string").write.parquet(str(tmp_path / "panel_list.parquet"))
    spark.createDataFrame([(1,)], "caption_id long").write.parquet(str(tmp_path / "individual_caption.parquet"))
    got = registry.QUERIES["q41b_expected_labels"](spark, str(tmp_path)).collect()
    assert sorted(r.panel_id for r in got) == [3, 5, 6, 7]


def test_nearest_to_original_or_most_confident(spark):
    rows = [("a", 1, 0.0, 0.0, 0.9), ("a", 2, 4.0, 4.0, 0.1), ("a", 3, 6.0, 4.0, 0.5), ("b", 4, 0.0, 0.0, 0.2), ("b", 5, 9.0, 9.0, 0.8), ("b", 6, 1.0, 1.0, None), ("c", 7, 1.0, 1.0, 0.3)]
    points = spark.createDataFrame(rows, "k string, i int, x double, y double, c double")
    originals = spark.createDataFrame([("a", 5.0, 4.0), ("c", None, None), ("z", 1.0, 1.0)], "k string, x double, y double")
    got = dedup.nearest_to_original(points, originals, "k", "i", ["x", "y"], "c").collect()
    assert len(got) == len(rows) and {r.i for r in got if r.is_winner} == {2, 5, 7}
    assert {r.i: r.distance for r in got if r.k != "c"} == {1: 41.0, 2: 1.0, 3: 1.0, 4: None, 5: None, 6: None}


def test_longest_prefix_against_all_pairs(spark):
    rng = random.Random(3)
    word = lambda n: "".join(rng.choice("ab") for _ in range(n))
    prefixes = sorted({word(rng.randint(1, 4)) for _ in range(8)})
    values = [word(rng.randint(0, 8)) for _ in range(50)] + [None]
    dims = spark.createDataFrame([(p, i) for i, p in enumerate(prefixes)], "p string, i int")
    got = linkage.longest_prefix(spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, v string"), "v", dims, "p", ["i"]).collect()
    for r in got:
        fits = [p for p in prefixes if r.v is not None and r.v.startswith(p)]
        assert r.i == (prefixes.index(max(fits, key=len)) if fits else None)


def test_upsert_and_unmatched(spark):
    a, b = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string"), spark.createDataFrame([(2, None), (3, "z")], "k int, v string")
    assert sorted(map(tuple, linkage.upsert(a, b, ["k"], ["v"]).collect())) == [(1, "x"), (2, "y"), (3, "z")]
    assert sorted(map(tuple, linkage.unmatched_kept(a, b, ["k"]).collect())) == [(1, "left"), (2, "both"), (3, "right")]


def brute_chunks(sizes, limit):
    out, number, total, fresh = [], 0, 0, True
    for s in sizes:
        if s > limit:
            number, fresh = number + 1, True
        elif fresh or total + s > limit:
            number, total, fresh = number + 1, s, False
        else:
            total += s
        out.append(number)
    return out


def test_chunks_lose_nothing_and_keep_the_limit(spark):
    rng = random.Random(5)
    rows = [(g, o, rng.choice([None, 0, 3, 5, 9, 40])) for g in (1, 2, None) for o in range(60)]
    got = chunking.chunk(spark.createDataFrame(rows, "g int, o int, s int"), "g", "o", "s", 20).collect()
    assert len(got) == len(rows)
    for g in (1, 2, None):
        mine = sorted((r for r in got if r.g == g), key=lambda r: r.o)
        assert [r.chunk_no for r in mine] == brute_chunks([r.size for r in mine], 20)


def test_fold_and_describe(spark):
    df = spark.createDataFrame([(1, "passed", 1.0), (1, "failed", 3.0), (2, "error", None), (2, "failed", 2.0), (3, "passed", None)], "g int, o string, v double")
    assert {r.g: r.status for r in rollup.fold_status(df, ["g"], "o").collect()} == {1: "degraded", 2: "error", 3: "success"}
    d = {r.g: r for r in rollup.describe(df, ["g"], F.col("v")).collect()}
    assert d[1].p50 == 2.0 and d[3].n == 0 and d[3]["mean"] is None


def test_model_calls_retry_and_fall_back(spark):
    class Flaky:
        def __init__(self):
            self.calls = 0

        def complete(self, prompt):
            self.calls += 1
            if "never" in prompt or self.calls % 2:
                raise TimeoutError("timed out")
            return prompt.upper()

    df = spark.createDataFrame([(1, "abcd"), (2, None), (3, ""), (4, "never")], "i int, p string").coalesce(1)
    got = {r.request_id: r for r in model.complete_all(df, "i", "p", Flaky, attempts=2, wait=0.0).collect()}
    assert got[1].reply == "ABCD" and got[1].attempts == 2
    assert got[2].reply is None and got[2].error is None and got[3].attempts == 0
    assert got[4].reply is None and got[4].error.startswith("TimeoutError")
    got = {r.request_id: r for r in model.complete_all(df, "i", "p", Flaky, model.RuleClient, attempts=1, wait=0.0).collect()}
    assert "never" in got[4].reply
    assert model.waits(6) == [1, 2, 4, 8, 8]


def test_salting_and_spreading(spark):
    assert [spark.range(1).select(salt_count(F.lit(n), 10)).first()[0] for n in (0, 1, 10, 11, 95)] == [1, 1, 1, 2, 10]
    df = spark.range(10, numPartitions=1)
    assert spread(df).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert spread(spark.range(10, numPartitions=50)).rdd.getNumPartitions() == 50


def test_stream_equals_table(spark, small_data, tmp_path):
    """Streamed windows that are closed have the table's counts."""
    events = spark.read.parquet(f"{small_data}/events.parquet")
    events.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))
    q = streams.by_window(stream).writeStream.outputMode("append").format("memory").queryName("windows").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    counts = lambda df: {(r.w, r.event_type): r.n for r in df.select(F.col("window_start").cast("string").alias("w"), "event_type", "n").collect()}
    got, want = counts(spark.table("windows")), counts(streams.by_window(events))
    assert got and all(want[k] == n for k, n in got.items())
    assert len(got) >= len(want) - 2 * events.select("event_type").distinct().count()


def test_repeats_in_a_stream_and_sessions(spark, small_data, tmp_path):
    events = spark.read.parquet(f"{small_data}/events.parquet")
    events.unionByName(events).write.parquet(str(tmp_path / "in"))
    stream = streams.first_seen(spark.readStream.schema(events.schema).parquet(str(tmp_path / "in")))
    q = stream.writeStream.format("memory").queryName("once").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.table("once").count() == events.select("event_id").distinct().count()
    assert streams.sessions(events).agg(F.sum("n")).first()[0] == events.count()


@pytest.mark.parametrize("limit", [None, 0])
def test_patterns_against_every_pair(spark, monkeypatch, limit):
    import re

    if limit is not None:
        monkeypatch.setattr(linkage, "BROADCAST_ROWS", limit)
    patterns = [r"AB\\d{3}", r"AB-?\\d+", "ABC", r"\\d+", "(X|Y)\\\\d", "AB|CD", "A*B", "Z", None]
    patterns = [p.replace("\\\\", "\\") if p else p for p in patterns]
    values = ["AB123", "AB-1", "ABC", "123", "X1", "AB", "CD", "AAB", "B", "Z", "ZZ", "", None]
    df = spark.createDataFrame([(v, 1) for v in values], "v string, i int")
    got = {(r.v, r.n) for r in linkage.pattern_matches(df, "v", spark.createDataFrame([(p, k) for k, p in enumerate(patterns)], "p string, n int"), "p", ["n"]).collect()}
    assert got == {(v, k) for v in values if v is not None for k, p in enumerate(patterns) if p and re.fullmatch(p, v)}


def test_free_labels_of_a_dealt_out_group(spark, monkeypatch):
    monkeypatch.setattr(dedup, "ROWS_PER_PART", 100)
    rows = [(1, k, "A" if k == 0 else None) for k in range(1500)]
    got = dedup.free_labels(spark.createDataFrame(rows, "g int, o int, l string"), "g", "o", "l").orderBy("o").collect()
    assert [r.new_label for r in got] == brute_labels({"A"}, 1499)
