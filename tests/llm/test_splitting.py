import pytest
from hypothesis import given
from hypothesis import strategies as st

from folioforge.llm.splitting import bodies, pieces, split_fields

TEXT = st.text(st.sampled_from("ab \n\r.,;<>()Fig1éé🙂"), max_size=400)


@given(TEXT, st.integers(2, 60), st.integers(0, 30))
def test_pieces_fit_overlap_and_lose_nothing(text, size, overlap):
    if overlap >= size:
        with pytest.raises(ValueError):
            pieces(text, size, overlap)
        return
    got = pieces(text, size, overlap)
    assert "".join(text[b:e] for b, _, e in got) == text
    assert all(e - s <= size for _, s, e in got)
    for (_, s0, e0), (b1, s1, _) in zip(got, got[1:]):
        assert b1 == e0 and text[s1:b1] == text[max(0, e0 - overlap) : e0] and s1 >= s0


def test_natural_places_come_first():
    text = "Figure 1. One thing. " + "Some words here. " * 10 + "\n\nFigure 2. Two. " + "More words there. " * 10
    cuts = [text[b:e] for b, e in bodies(text, 220)]
    assert cuts[1].startswith("Figure 2.") and len(cuts) == 2
    assert all(c.rstrip().endswith(".") for b, e in bodies(text, 60) for c in [text[b:e]])


def test_nothing_merges_across_parents():
    one, two = "Figure 1. " + "Some words here. " * 20, "Figure 2. Short one. "
    text = one + "\n\n" + two + "\n\n" + two.replace("2", "3")
    cuts = [text[b:e] for b, e in bodies(text, 150)]
    assert cuts[-1].startswith("Figure 2.") and "Figure 3." in cuts[-1]
    assert all("Figure" not in c for c in cuts[1:-1])


def test_headings_nest_by_rank():
    text = "# A\n" + "".join(f"## A{i}\n" + "word " * 10 + "\n" for i in range(3)) + "# B\n" + "".join(f"## B{i}\n" + "word " * 4 + "\n" for i in range(3))
    cuts = [text[b:e] for b, e in bodies(text, 130)]
    assert [c.split("\n")[0] for c in cuts] == ["# A", "## A2", "# B"] and cuts[2].count("##") == 3
    html = "<h1>A</h1>" + "<p>x y z.</p>" * 4 + "<h2>A1</h2><p>word word.</p><h1>B</h1><p>q</p>"
    assert [html[b:e][:6] for b, e in bodies(html, 75)] == ["<h1>A<", "<h2>A1", "<h1>B<"]


def test_lists_nest_by_depth():
    text = "".join(f"- item {i}\n" + "".join(f"  - part {i}.{k}\n" for k in range(3)) for i in range(4))
    assert all(text[b:e].startswith("- item") for b, e in bodies(text, 90))
    html = "<ul>" + "".join(f"<li>item {i}<ul>" + "".join(f"<li>part {k}</li>" for k in range(3)) + "</ul></li>" for i in range(3)) + "</ul>"
    assert all("<li>item" in html[b:e] for b, e in bodies(html, 100))


def test_long_tags_and_long_abbreviations():
    tag = '<a title="' + "word " * 60 + '">'
    text = "word " * 10 + tag + " word" * 10
    assert any(text[b:e].startswith(tag) for b, e in bodies(text, 320))
    assert [e - b for b, e in bodies("It was notapprox. Then it was approx. Five of them. ", 40)] == [18, 34]
    assert len(bodies("\n".join(" " * i + "x" for i in range(3000)), 500)) > 1000  # a staircase of lists


def test_abbreviations_and_marks_are_not_parted():
    text = "Cells were lost (see e.g. Fig. 3 and Dr. B. Smith). Then more came. "
    assert [text[b:e] for b, e in bodies(text, 55)] == ["Cells were lost (see e.g. Fig. 3 and Dr. B. Smith). ", "Then more came. "]
    accents = "é" * 50
    assert all(not accents[b:e].startswith("́") for b, e in bodies(accents, 7))
    crlf = "ab\r\ncd\r\n" * 5
    assert all(not crlf[b:e].startswith("\n") for b, e in bodies(crlf, 6))


def test_siblings_merge_up_to_the_limit():
    text = "\n".join(f"- item {i}" for i in range(40))
    got = bodies(text, 100)
    assert all(100 - 20 < e - b <= 100 for b, e in got[:-1])


def test_long_texts_without_places():
    assert len(bodies("x" * 1_000_000, 1000)) == 1000
    assert "".join("\n" * 50_000) == "".join(("\n" * 50_000)[b:e] for b, e in bodies("\n" * 50_000, 1000))


def test_fields(spark):
    rows = [(1, "a " * 30, None), (2, "", "b" * 20), (3, None, "c" * 21), (3, None, "c" * 21)]
    df = spark.createDataFrame([(*r, "clash", 0) for r in rows], "section_id bigint, figure_legends string, data_availability string, piece string, start int")
    limits = spark.createDataFrame([("figure_legends", "chars", 40, 8), ("data_availability", "chars", 20, 5)], "limit_name string, unit string, max_size int, overlap_size int")
    fields = ["figure_legends", "data_availability"]
    got = [tuple(r) for r in split_fields(df, limits, "section_id", fields).collect()]
    assert {(r[0], r[1]): 0 for r in got} == {(1, "figure_legends"): 0, (2, "figure_legends"): 0, (2, "data_availability"): 0, (3, "data_availability"): 0}
    assert all(len(r[6]) <= (40 if r[1] == "figure_legends" else 20) for r in got)
    assert sorted({(r[0], r[1]) for r in got if r[2] == 2}) == [(1, "figure_legends"), (3, "data_availability")]
    assert len([r for r in got if r[0] == 3 and r[2] == 1]) == 2
    assert split_fields(df.limit(0), limits, "section_id", fields).count() == 0
    assert split_fields(df, limits.limit(0), "section_id", fields).count() == 5
