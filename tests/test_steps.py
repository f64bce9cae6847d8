import base64
import json

import pytest
from pyspark.sql import functions as F

from folioforge.functions import replies, text
from folioforge.operators import steps
from folioforge.sources import sinks, tables


def test_steps_read_typed_answers_with_defaults(spark):
    class Echo:
        """Answers with what follows the last line break of the prompt."""

        def complete(self, prompt):
            return prompt.rsplit("\n", 1)[-1]

    rows = [(1, json.dumps({"figure_caption": "C", "figure_label": "Figure 1", "is_verbatim": True})), (2, "nothing to read"), (3, None), (4, "")]
    got = {r.i: r for r in steps.CAPTIONS.run(spark.createDataFrame(rows, "i long, all_captions string"), "i", Echo).collect()}
    assert (got[1].answer.figure_caption, got[1].answer.caption_title, got[1].answer.is_verbatim) == ("C", "", True) and got[1].prompt_tokens > 0
    assert all(got[i].answer.figure_caption == steps.NO_CAPTION for i in (2, 3, 4)) and got[3].attempts == 0 and got[4].attempts == 0
    listed = json.dumps({"assigned_files": [{"panel_label": "Fig1A", "panel_sd_files": ["x.csv", "invented"]}], "not_assigned_files": []})
    answers = steps.PANEL_FILES.run(spark.createDataFrame([(7, listed)], "i long, file_list string"), "i", Echo)
    kept = steps.assigned_panels(answers, "i", spark.createDataFrame([(7, "x.csv"), (8, "invented")], "i long, file string")).collect()
    assert [tuple(r) for r in kept] == [(7, "A", "", "x.csv")]
    panels = [(1, '{"panels": [{"panel_label": "A"}]}'), (2, '[{"panel_label": "B"}]'), (3, "?")]
    got = {r.i: [p.panel_label for p in r.answer] for r in steps.PANEL_CAPTIONS.run(spark.createDataFrame(panels, "i long, figure_caption string"), "i", Echo).collect()}
    assert got == {1: ["A"], 2: ["B"], 3: []}
    assert len({s.name for s in steps.ALL_STEPS}) == len(steps.ALL_STEPS)


def test_merged_replies(spark):
    chunk = lambda *files: json.dumps({"assigned_files": [{"panel_label": "A", "panel_sd_files": list(files)}], "not_assigned_files": ["n"]})
    rows = [(1, 2, chunk("b"), 1, 1, 2), (1, 1, chunk("a"), 2, 2, 4), (1, 3, "broken", 3, 3, 6), (2, 1, None, 1, 0, 1)]
    df = spark.createDataFrame(rows, "i int, o int, r string, prompt_tokens long, completion_tokens long, total_tokens long")
    got = {r.i: r for r in replies.merge_files(df, "i", "o", "r").collect()}
    assert [f.panel_sd_files for f in got[1].assigned_files] == [["a"], ["b"]] and got[1].not_assigned_files == ["n", "n"] and got[1].total_tokens == 12
    assert got[2].assigned_files == [] and got[2].total_tokens == 1


def test_step_log(spark, tmp_path):
    path = str(tmp_path / "log")
    fail = lambda: 1 / 0
    assert steps.run_step(spark, path, "r", "fine", lambda: spark.range(3), True).count() == 3
    assert steps.run_step(spark, path, "r", "optional", fail, False) is None
    with pytest.raises(ZeroDivisionError):
        steps.run_step(spark, path, "r", "needed", fail, True)
    got = {r.step: r.error for r in spark.read.parquet(path).collect()}
    assert got["fine"] is None and got["optional"].startswith("ZeroDivisionError") and got["needed"].startswith("ZeroDivisionError")


def test_json_sources(spark, tmp_path):
    (tmp_path / "f.json").write_text(json.dumps([["Figure 1", "QUJD", "cap"], ["too", "short"]]))
    assert [tuple(r) for r in tables.read_figures(spark, str(tmp_path / "f.json")).collect()] == [("Figure 1", "QUJD", "cap")]
    (tmp_path / "g.json").write_text("{broken")
    assert tables.read_figures(spark, str(tmp_path / "g.json")).count() == 0 and tables.read_figures(spark, str(tmp_path / "none.json")).count() == 0
    truth = tmp_path / "truth"
    truth.mkdir()
    (truth / "M-1.json").write_text('{"figures": []}')
    (truth / "M-2.json").write_text("{")
    got = tables.read_ground_truth(spark, str(truth), spark.createDataFrame([("M-1",), ("M-2",), ("M-3",)], "manuscript_id string")).collect()
    assert {r.manuscript_id: (r.document, r.error) for r in got} == {"M-1": ('{"figures": []}', None), "M-2": (None, "no JSON"), "M-3": (None, "missing")}


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("Figure 1/A", base64.b64encode(b"abc").decode(), "cap"), ("b", "data:image/png;base64,QUJD", None), ("c", "no base64!", ""), ("d", None, "")], "l string, p string, c string")
    got = {r.name: (r.kind, r.bytes) for r in sinks.write_payloads(df, str(tmp_path / "out"), "l", "p", "c").collect()}
    assert got["figure_1_a.png"] == ("image", 3) and got["c"] == ("error", 0) and (tmp_path / "out" / "b.png").read_bytes() == b"ABC" and (tmp_path / "out" / "figure_1_a.txt").read_text() == "cap"
    assert tuple(sinks.payload_properties(df, "l", "p").first()) == (4, 3, 4, 4, 26)
    path = str(tmp_path / "r")
    sinks.append_results(spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string"), path, ["k"])
    sinks.append_results(spark.createDataFrame([(1, "c"), (2, "d")], "k int, v string"), path, ["k"])
    assert sorted(r.k for r in spark.read.parquet(path).collect()) == [1, 2]
    sinks.write_json(df.limit(1).select("l"), str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).first()[0] == "Figure 1/A"
    assert df.limit(1).select(sinks.whole_json(F.struct("l", F.lit(None).cast("string").alias("x")))).first()[0] == '{"l":"Figure 1/A","x":null}'


def test_small_helpers(spark):
    row = spark.createDataFrame([("ª┬ í≈.csv", "Test A", 0.5)], "n string, t string, p double").select(text.repair_name(F.col("n")), steps.case_key(F.col("t"), F.lit(3), F.col("p"))).first()
    assert tuple(row) == ("β △.csv", "test_a_3_0.5")
    assert json.loads(steps.registry_text(spark.createDataFrame([(2, "b"), (1, "a")], "i int, name string"))) == [{"i": 1, "name": "a"}, {"i": 2, "name": "b"}]
