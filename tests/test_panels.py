import random

import pytest
from pyspark.sql import functions as F

from folioforge.operators import panels, scores

MATCH = "figure string, detection_idx long, panel_label string, panel_caption string, x1 double, y1 double, x2 double, y2 double, confidence double"
KNOWN = "figure string, place long, panel_label string, panel_caption string, x1 double, y1 double, x2 double, y2 double"


def brute(matches, originals):
    """One figure after the other, as a person would."""
    out, lost = [], []
    for f in sorted({m[0] for m in matches} | {o[0] for o in originals}):
        known = {}
        for o in sorted((o for o in originals if o[0] == f), key=lambda o: o[1]):
            known[o[2].upper()] = o
        groups = {}
        for m in sorted((m for m in matches if m[0] == f), key=lambda m: m[1]):
            groups.setdefault(m[2].upper() if (m[2] or "").strip() else m[1], []).append(m)
        used = set()
        for key, ms in groups.items():
            o = known.get(key)
            centre = lambda b: ((b[0] + b[2]) / 2, (b[1] + b[3]) / 2)
            if o and o[4] is not None:
                (p, q) = centre(o[4:8])
                best = min(ms, key=lambda m: ((centre(m[4:8])[0] - p) ** 2 + (centre(m[4:8])[1] - q) ** 2))
            else:
                best = max(ms, key=lambda m: m[8])
            label = next((x for x in panels.ALL_LABELS if x not in used), "unknown") if isinstance(key, int) else o[2] if o else ms[0][2]
            used.add(label.upper())
            out.append((f, label, o[3] if o else best[3], best[8]))
            lost += [(f, label, m[1]) for m in ms if m is not best]
        firsts = {}
        for o in sorted((o for o in originals if o[0] == f), key=lambda o: o[1]):
            firsts.setdefault(o[2].upper(), o)
        out += [(f, o[2], o[3], None) for k, o in firsts.items() if k not in used]
    return sorted(map(str, out)), sorted(lost)


@pytest.mark.parametrize("seed", range(3))
def test_conflicts_as_one_by_one(spark, seed):
    rng = random.Random(seed)
    number = lambda: round(rng.random(), 3)
    matches = [(rng.choice("fgh"), i, rng.choice(["A", "a", "B", "C", "", " ", None, "D"]), f"m{i}", *(number() for _ in range(4)), number()) for i in range(40)]
    originals = [(rng.choice("fgk"), i, rng.choice(["A", "b", "C", "E", "e"]), f"o{i}", *([number() for _ in range(4)] if i % 3 else [None] * 4)) for i in range(12)]
    m, o = spark.createDataFrame(matches, MATCH), spark.createDataFrame(originals, KNOWN)
    got = [str((r.figure, r.panel_label, r.panel_caption, r.confidence)) for r in panels.resolve(m, o).collect()]
    lost = sorted((r.figure, r.panel_label, r.detection_idx) for r in panels.conflicts(m, o).collect())
    assert (sorted(got), lost) == brute(matches, originals)


def test_one_side_only_and_many_blanks(spark):
    m = spark.createDataFrame([("f", i, None, "c", 0.0, 0.0, 1.0, 1.0, 0.5) for i in range(705)], MATCH)
    o = spark.createDataFrame([("g", 1, "A", "c", None, None, None, None)], KNOWN)
    got = {r.place: r.panel_label for r in panels.resolve(m, o.limit(0)).collect()}
    assert [got[0], got[25], got[26], got[701], got[702], got[704]] == ["A", "Z", "AA", "ZZ", "unknown", "unknown"]
    assert [r.origin for r in panels.resolve(m.limit(0), o).collect()] == ["original"]


def test_file_and_panel_scores(spark):
    rows = [(["a", "b"], ["b"], 0.5), ([], [], 1.0), (None, None, 1.0), ([], ["x"], 0.0), (["x"], [], 0.0), (["a", "a"], ["a"], 0.5)]
    df = spark.createDataFrame(rows, "e array<string>, a array<string>, want double")
    assert df.where(scores.file_score(F.col("e"), F.col("a")) != F.col("want")).count() == 0
    e = spark.createDataFrame([("f", "A", ["x"]), ("f", "B", []), ("g", "A", ["y"])], "figure string, panel string, files array<string>")
    a = spark.createDataFrame([("f", "A", ["x", "z"]), ("h", "A", ["q"])], "figure string, panel string, files array<string>")
    assert {(r.figure, r.panel): r.score for r in scores.panel_scores(e, a).collect()} == {("f", "A"): 1, ("f", "B"): 1, ("g", "A"): 0}
    assert {(r.figure, r.panel) for r in scores.panel_scores(e, a, found_figures_only=True).collect()} == {("f", "A"), ("f", "B")}


def test_source_scores(spark):
    s = "k string, database string, accession_number string, url string"
    e = spark.createDataFrame([("m", "GEO", "G1", ""), ("m", " geo ", "g1", ""), ("m", "NCBI Archive", None, ""), ("n", "X", "1", "")], s)
    a = spark.createDataFrame([("m", "geo", "G1", ""), ("m", "ncbi", None, ""), ("p", "Y", "2", "")], s)
    got = {r.k: (round(r.exact, 4), round(r.likeness, 4), round(r.score, 4)) for r in scores.source_scores(e, a, "k").collect()}
    assert got == {"m": (0.6667, 0.9167, 0.7917), "n": (0, 0, 0), "p": (0, 0, 0)}
