import itertools
import random

import pytest
from hypothesis import given
from hypothesis import strategies as st

from folioforge.llm.registry_match import BKTree, Matcher, edit_distance, match_names

ENTRIES = [
    (1, "Nuclear Spin Data Bank", "https://nsd.example.org/entry/{$id}", "https://ids.example.org/nsd:", r"^NSD\d{5}$", "NSD79425"),
    (2, "European Glycome Archive Dataset", "https://egd.example.org/entry/{$id}", "https://ids.example.org/egd:", r"^EGD-\d{9}$", "EGD-234936760"),
    (3, "European Glycome Archive Study", "https://egs.example.org/entry/{$id}", "https://ids.example.org/egs:", r"^EGS\d{9}$", "EGS849970986"),
    (4, "Mouse Organ Atlas", "https://moa.example.org/entry/{$id}", "https://ids.example.org/moa:", r"^MOA\d{5}$", "MOA03458"),
    (5, "Tumour Panel Centre", "https://tpc.example.org/entry/{$id}", "https://ids.example.org/tpc:", r"^TPC\d{8}$", "TPC20925616"),
]


@pytest.fixture(scope="module")
def matcher():
    return Matcher(ENTRIES)


@pytest.mark.parametrize(
    ("value", "accession", "want"),
    [
        ("nuclear spin data bank", None, 1), ("Nuclear_Spin-Data/Bank", None, 1), ("Bank, Nuclear Spin Data", None, 1), ("Nuclear Spin Databank", None, 1), ("N.S.D.", None, 1),
        ("deposited in Nuclear Spin", None, 1), ("NSD:NSD12345", None, 1), ("https://nsd.example.org", None, 1), ("Nuclear Spin Data Bank (public), release 3", None, 1),
        ("Ncuelar Sipn Data Bank", None, 1), ("Tumor Panel Center", None, 5), ("Eur. Glycome Arch. Data set", None, 2), ("Mouse Organ Atlas/moa", None, 4),
        ("European Glycome Archive", "EGS849970986", 3), ("European Glycome Archive", "EGD-234936760", 2), ("European Glycome Archive", None, 0), ("EGA", "EGS849970986", 3),
        ("Sponge Spin Data Bank", "NSD12345", 0), ("Bird Organ Atlas", "MOA03458", 0), ("in-house server", None, 0), ("available on request", None, 0), ("?!", None, 0), ("x" * 100_000, None, 0), ("the " * 5_000, None, 0),
    ],
)
def test_values(matcher, value, accession, want):
    assert matcher.search(value, accession) == want


WORDS = st.text("abc", max_size=6)


@given(WORDS, WORDS, WORDS)
def test_distance_is_a_metric(a, b, c):
    assert (edit_distance(a, b) == 0) == (a == b)
    assert edit_distance(a, b) == edit_distance(b, a)
    assert edit_distance(a, c) <= edit_distance(a, b) + edit_distance(b, c)


def test_swaps_cost_one():
    assert edit_distance("abcd", "acbd") == 1 and edit_distance("ca", "abc") == 2


def test_tree_finds_all_within_the_threshold():
    rng = random.Random(2)
    keys = sorted({"".join(rng.choice("abcd") for _ in range(rng.randint(1, 7))) for _ in range(300)})
    tree = BKTree(keys)
    for most, query in itertools.product((0, 1, 2, 3), keys[:20] + ["", "dcba", "zzzz"]):
        assert tree.within(query, most) == sorted((d, k) for k in keys if (d := edit_distance(query, k)) <= most)


@pytest.mark.parametrize("leaf", [1, 4, 48])
def test_leaves_of_any_size_find_the_same(monkeypatch, leaf):
    monkeypatch.setattr(BKTree, "LEAF", leaf)
    rng = random.Random(9)
    keys = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(1, 9))) for _ in range(200)})
    tree = BKTree(keys * 2)
    for query in [*keys[:15], "", "cbacba"]:
        assert tree.within(query, 2) == sorted((d, k) for k in keys if (d := edit_distance(query, k)) <= 2)


@pytest.mark.parametrize("value", ["the " * 300 + "Nuclear Spin Data Bank" + " database" * 300, "in our public record of the project data site at web portal Nuclear Spin Data Bank repository server page id 7"])
def test_any_number_of_wrapping_words(matcher, value):
    assert matcher.search(value) == 1


def test_shards_of_the_test_list_agree(spark):
    """The whole list of the test data in one, four and seven shards."""
    from folioforge.sources.tables import table

    folder = "/root/testdata/sf0.01"
    names = table(spark, folder, "identifiers")
    whole, *parts = ({tuple(r) for r in match_names(table(spark, folder, "data_source"), names, entries_per_shard=n).collect()} for n in (100, 13, 8))
    assert len(whole) > 500 and all(p == whole for p in parts)


def test_rows(spark):
    schema = "data_source_id bigint, database string, accession_number string, url string, rank int, registry_id string"
    rows = [(1, "Nuclear Spin Data Bank", None, None), (2, None, None, None), (3, "  ", None, None), (4, "nsd", None, None), (5, "nsd", "NSD1", ""), (6, "nowhere", None, None), (7, "European Glycome Archive", None, "https://egs.example.org/x")]
    df = spark.createDataFrame([(*r, 1, "clash") for r in rows], schema)
    entries = spark.createDataFrame([(*e, "type") for e in ENTRIES] + [(9, None, None, None, None, None, None)], "registry_id bigint, name string, url_pattern string, identifiers_pattern string, local_unique_identifier_pattern string, sample_id string, type string")
    whole = {(r.data_source_id, r.registry_id, r.exact) for r in match_names(df, entries).collect()}
    assert whole == {(1, 1, True), (4, 1, False), (5, 1, False), (6, 0, False), (7, 3, False)}
    assert {(r.data_source_id, r.registry_id, r.exact) for r in match_names(df, entries, entries_per_shard=2).collect()} == whole
    assert {r.registry_id for r in match_names(df, entries.limit(0)).collect()} == {0}
    assert match_names(df.limit(0), entries).count() == 0


@pytest.mark.parametrize("per_shard", [1, 3])
def test_alike_entries_in_different_shards_are_told_apart(spark, per_shard):
    """Every list size has the same answer, and repeated ids keep their rows."""
    entries = ENTRIES + [(6, "European Glycome Archive Sample", "https://ega.example.org/entry/{$id}", "https://ids.example.org/ega:", r"^EGA-\d{9}$", "EGA-1"), (7, "Tumour Panel Cohort", "https://tpd.example.org/x", "https://ids.example.org/tpd:", r"^TPD\d+$", "TPD1")]
    entries += [(8, "Mouse Organ Atlas", "https://moc.example.org/x", "https://ids.example.org/moc:", r"^MOC\d+$", "MOC1"), (9, "Mousse Orchard", "https://mor.example.org/x", "https://ids.example.org/mor:", None, None)]
    values = ["European Glycome Archive", "Eur. Glycome Arch.", "Tumour Panel", "Tumor Panel Cen", "Mouse Organ Atlas", "Mouse Organ", "Mous Orgxn Atl", "Glycome Nucleir Spin", "EGA", "nowhere"]
    accessions, urls = [None, "EGD-234936760", "EGS849970986", "EGA-234936760", "TPC20925616", "MOC1"], [None, "", "https://egs.example.org/x", "see https://ega.example.org/entry/1"]
    rows = [(i // 2, *r) for i, r in enumerate(itertools.product(values, accessions, urls))]
    df = spark.createDataFrame(rows, "data_source_id bigint, database string, accession_number string, url string")
    listed = spark.createDataFrame(entries, "registry_id bigint, name string, url_pattern string, identifiers_pattern string, local_unique_identifier_pattern string, sample_id string")
    answers = lambda n: sorted((r.data_source_id, r.database, r.registry_id, r.exact) for r in match_names(df, listed, entries_per_shard=n).collect())
    whole = answers(100)
    assert len(whole) == len(rows) and answers(per_shard) == whole
    assert {2, 3, 6} <= {r[2] for r in whole if r[1] == "European Glycome Archive"}
