import json

import pyarrow as pa
import pytest
from hypothesis import given
from hypothesis import strategies as st

from folioforge.operators import nested

PANEL = {"panel_label": "A", "panel_bbox": [0.1, 0.2, 0.3, 0.4], "sd_files": ["a.csv", None, "b.csv"]}


def frame(spark, payloads):
    rows = [(i, p, "clash", 7) for i, p in enumerate(payloads, 1)]
    return spark.createDataFrame(rows, "record_id bigint, payload string, child string, figure_no int")


def found(spark, *payloads):
    got = nested.bridge(frame(spark, payloads), only=nested.CHILDREN).collect()
    return sorted((r.record_id, r.child, r.figure_no, r.panel_no, r.item_no) for r in got)


def test_positions_and_layouts(spark):
    doc = {"figures": [None, {"sd_files": "x.tif", "panels": [PANEL, None, {"panel_bbox": "0.1, 0.2,0.3,0.4"}]}]}
    want = [
        ("figure", 2, 0, 0), ("figure_file", 2, 0, 1), ("panel", 2, 1, 0), ("panel", 2, 3, 0), ("panel_bbox", 2, 1, 0), ("panel_bbox", 2, 3, 0),
        ("panel_file", 2, 1, 1), ("panel_file", 2, 1, 3),
    ]
    texts = [json.dumps(doc), json.dumps({"schema": 1, "manuscript": doc}), json.dumps({"result": {"status": "ok", "structure": doc}}, indent=1)]
    assert found(spark, *texts) == sorted((i, *w) for i in (1, 2, 3) for w in want)


def test_single_children_without_their_arrays(spark):
    doc = {"figures": {"panels": {"sd_files": "only.csv", "panel_bbox": {"x1": 0, "y1": 0, "x2": 1, "y2": 1}}}}
    assert found(spark, json.dumps(doc)) == [(1, "figure", 1, 0, 0), (1, "panel", 1, 1, 0), (1, "panel_bbox", 1, 1, 0), (1, "panel_file", 1, 1, 1)]


def test_invalid_null_and_empty_payloads_give_nothing(spark):
    bad = [None, "", "{", '{"figures": [{}]} trailing', '{"figures": [NaN]}', "[]", "3", '{"figures": null}', '{"figures": [1, "x", []]}', "[" * 100_000]
    assert found(spark, *bad) == []
    assert nested.bridge(frame(spark, []).limit(0)).count() == 0


@pytest.mark.parametrize("value", [[0.1, 0.2, 0.3], [0.1, None, 0.3, 0.4], [], None, "", "1,2,3", {"x1": 1, "y1": 2, "x2": 3}, [1, 2, 3, True], "a,b,c,d", 7])
def test_incomplete_boxes(value):
    assert nested.box(value) is None


@pytest.mark.parametrize("value", [[0, 0, 1, 1], "0,0,1,1", "[0, 0, 1, 1]", {"x1": 0, "y1": 0, "x2": 1, "y2": 1}])
def test_complete_boxes(value):
    assert nested.box(value) == [0, 0, 1, 1]


def test_repeats_count_each_but_are_stored_once(spark):
    text = json.dumps({"figures": [{"panels": [PANEL, PANEL]}, {"panels": [PANEL]}]})
    parts = nested.decompose(frame(spark, [text] * 3)).cache()
    rows = parts.collect()
    panels = [r for r in rows if r.child == "panel"]
    assert len(panels) == 9 and len({r.node_id for r in panels}) == 1
    store = {r.node_id: r.body for r in nested.store(parts).collect()}
    assert {r.node_id for r in rows} == set(store)
    assert {r.parent_id for r in rows} <= set(store) | {None}
    assert sum('"panel_bbox":[0.1,0.2,0.3,0.4]' in b for b in store.values()) == 1
    assert [r.ordinal for r in rows if r.child == "panel_file"] == [1, 3] * 9


def test_objects_at_any_depth_keep_their_parent_field_and_place(spark):
    doc = {"figures": [{"panels": [3, {"other": {"deep": [[{"x": 1}], {"x": 2}]}}], "panel": {}}], "note": [None, {"a": []}]}
    rows = nested.decompose(frame(spark, [json.dumps(doc)])).collect()
    body = {r.node_id: r.body for r in rows if r.body}
    assert sorted((r.child, r.field, r.ordinal, body[r.node_id]) for r in rows if r.child == "object" and "@" not in body[r.node_id]) == [
        ("object", "deep", 1, '{"x":1}'), ("object", "deep", 2, '{"x":2}'), ("object", "note", 2, '{"a":[]}'), ("object", "panel", 1, "{}"),
    ]
    assert [(r.figure_no, r.panel_no) for r in rows if r.field == "other"] == [(1, 2)]
    assert {r.parent_id for r in rows} <= {r.node_id for r in rows} | {None}


def test_fields_of_flat_rows(spark):
    odd = {**PANEL, "panel_bbox": "(1; 2; 3;4)", "confidence": "0.5", "hallucination_score": True, "sd_files": ['a"b\\c.csv']}
    df = frame(spark, [json.dumps({"figures": [{"figure_label": "F1", "caption_title": "T", "panels": [PANEL, odd, {"panel_bbox": {"x1": 1, "y1": "2", "x2": 3, "y2": 4.5}}]}]})])
    xy = nested.flat(df, "panel_bbox").select("panel_no", *nested.coordinates()).orderBy("panel_no").collect()
    assert [tuple(r) for r in xy] == [(1, 0.1, 0.2, 0.3, 0.4), (2, 1, 2, 3, 4), (3, 1, 2, 3, 4.5)]
    panels = nested.flat(df, "panel").select("panel_no", nested.number_of(nested.text_field("confidence")), nested.number_of(nested.text_field("hallucination_score"))).orderBy("panel_no").collect()
    assert [tuple(r) for r in panels] == [(1, None, None), (2, 0.5, None), (3, None, None)]
    assert nested.flat(df, "figure").select(nested.text_field("caption_title")).first()[0] == "T"
    assert nested.flat(df.limit(0), "figure").count() == 0


def test_every_valid_payload_can_be_put_together_again(spark):
    from folioforge.sources.tables import table

    odd = ["3", '"x"', "null", "[[{}], 2]", '{"a": "\\ud800", "\\udc00": [1.0, 1e3, -0]}', '{"a": {"b": {"a": {"b": {}}}}}', "1" * 5000, "[" + "1" * 5000 + "]"]
    df = table(spark, "/root/testdata/sf0.001", "manuscript_records").select("record_id", "payload").unionByName(frame(spark, odd).selectExpr("record_id + 1000000 AS record_id", "payload"))
    want = {r.record_id: json.dumps(v, sort_keys=True) for r in df.collect() if (v := nested.parse(r.payload)) is not None or r.payload == "null"}
    got = {r.record_id: json.dumps(json.loads(r.payload), sort_keys=True) for r in nested.restore(nested.decompose(df).cache()).collect()}
    assert len(want) > 20 and got == want


JSON = st.recursive(st.none() | st.booleans() | st.integers(-9, 9) | st.text(max_size=3), lambda x: st.lists(x, max_size=3) | st.dictionaries(st.text(max_size=2), x, max_size=3), max_leaves=12)


@given(JSON, JSON)
def test_identity_is_equality(a, b):
    same = json.dumps(a, sort_keys=True) == json.dumps(b, sort_keys=True)
    assert (nested.Merkle(a).root == nested.Merkle(b).root) == same


@given(JSON)
def test_objects_can_be_put_together_again(value):
    m = nested.Merkle(value)
    assert json.dumps(nested.rebuild(m.root, m.store), sort_keys=True) == json.dumps(value, sort_keys=True)
    rows = list(nested.occurrences(1, value, m))
    assert {r[8] for r in rows} <= {r[7] for r in rows} | {None} and {r[7] for r in rows} == set(m.store)


@pytest.mark.parametrize(("opening", "closing"), [('{"a":', "}"), ("[", "]"), ('[{"a":', "}]")])
def test_a_deep_field_drops_no_record(opening, closing):
    depth = 800 // len(closing)
    payload = '{"figures": [{"panels": [{}]}], "other": ' + opening * depth + "1" + closing * depth + "}"
    batch = pa.RecordBatch.from_pydict({"id": [1], "payload": [payload]})
    assert sum(b.num_rows for b in nested._walk(iter([batch]), nested.CHILDREN, False)) == 2
