import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioforge.functions import config
from folioforge.operators import checks, chunking
from folioforge.sources import sinks


def test_layers():
    layers = {"default": {"a": 1, "m": {"x": 1}}, "dev": {"a": 2, "m": {"x": 3}}, "m": {"y": 5}}
    assert config.for_environment(layers, "dev") == {"a": 2, "m": {"x": 3, "y": 5}}
    assert config.for_environment(layers, "gone") == {"a": 1, "m": {"x": 1, "y": 5}} | ({"dev": layers["dev"]})
    assert config.overlay({"a": {"b": 1, "c": 2}}, {"a": {"b": 9}, "d": None}) == {"a": {"b": 9, "c": 2}, "d": None}


def test_selectors():
    assert config.choose(["b", "a", "c"], "all") == ["a", "b", "c"] and config.choose(["b", "a"], "1") == ["a"] and config.choose(["b", "a"], "b, z") == ["b"]
    assert config.one_of({"x": 1}, ["x", "y"]) == "x" and config.one_of({}, ["x"]) is None
    with pytest.raises(ValueError):
        config.one_of({"x": 1, "y": 2}, ["x", "y"])
    assert config.out_of_range({"t": 3, "p": 0.5}, {"t": (0, 2), "p": (0, 1), "q": (0, 1)}) == ["t"]
    assert config.of_family("m-5-2025", ["m-5"]) and config.of_family("m-5", ["m-5"]) and not config.of_family("m-50", ["m-5"])
    assert len(config.grid(a=[1, 2], b="xyz")) == 6


def test_schemas():
    item = {"type": "object", "properties": {"panel_label": {"type": "string"}, "n": {"type": ["integer", "null"]}}, "required": ["panel_label"]}
    schema = {"type": "object", "properties": {"outputs": {"type": "array", "items": item}, "free": {"type": "object"}}}
    got = config.schema_of(schema)
    assert got["outputs"].dataType == T.ArrayType(T.StructType([T.StructField("panel_label", T.StringType(), False), T.StructField("n", T.LongType())]))
    assert got["free"].dataType == T.MapType(T.StringType(), T.StringType())
    assert config.level_of(schema) == "panel" and config.level_of({}, None, "document_ethics") == "document" and config.level_of({}, {"level": "figure"}) == "figure"
    assert config.missing_fields(got, T.StructType([T.StructField("free", T.StringType())])) == ["outputs"]


def test_wrapped_outputs_and_missing_fields(spark):
    df = spark.createDataFrame([('{"outputs": [{"k": 1}, {"k": 2}]}',), ('{"k": 3}',), ("{broken",), (None,), ("",), ("[]",)], "r string")
    got = [[x.k for x in r[0]] for r in df.select(checks.wrap_outputs(F.col("r"), "struct<k:bigint>")).collect()]
    assert got == [[1, 2], [3], [], [], [], []]
    missing = [r[0] for r in df.select(checks.required_fields(F.col("r"), ["k", "z"])).collect()]
    assert missing == [["k", "z"], ["z"], ["k", "z"], ["k", "z"], ["k", "z"], ["k", "z"]]


def test_results_and_rules(spark):
    df = spark.createDataFrame([(1, None, "a", True), (1, " ", "b", False), (1, "A", "b", False), (1, "A", "a", False), (1, "A", "a", False)], "s int, p string, c string, ok boolean")
    got = {r.p: (r.n_checks, r.n_passed, r.failed) for r in checks.results_by_subject(df, "s", "p", "c", "ok").collect()}
    assert got == {"unknown": (2, 1, "b"), "A": (3, 0, "a,b")}
    assert checks.results_by_subject(df.limit(0), "s", "p", "c", "ok").count() == 0
    tags = spark.createDataFrame([("Mean ± SD",), ("",), (None,)], "t string").select(checks.keyword_rules(F.col("t"), {"err": ("±",), "n": ("mean", "x")}))
    assert [r[0] for r in tags.collect()] == [["err", "n"], [], []]


@pytest.mark.parametrize("n_lines", [0, 1, 7, 60])
def test_prompts_keep_all_lines_within_the_limit(spark, n_lines):
    lines = [f"file number {i}" + "x" * (i % 5) for i in range(n_lines)]
    df = spark.createDataFrame([(1, "Do this.\nFiles:\n" + "\n".join(lines)), (2, "no list at all")], "i int, p string")
    got = chunking.chunk_prompts(df, "i", "p", "Files:", 140).orderBy("chunk_no").collect()
    mine = [r for r in got if r.i == 1]
    assert [x for r in mine for x in r.prompt.split("\n")[2:] if x] == lines
    assert all(r.prompt.startswith("Do this.\nFiles:") for r in mine)
    assert all(sum(len(x) // 4 + 1 for x in r.prompt.split("\n")[2:]) <= 40 for r in mine)
    assert [r.prompt for r in got if r.i == 2] == ["no list at all"]


def test_sizes_and_lines(spark):
    w, h = checks.fit_size(F.lit(40000.0), F.lit(20000.0))
    assert tuple(spark.range(1).select(w, h).first()) == (2048, 1023) or tuple(spark.range(1).select(w, h).first()) == (2048, 1024)
    w, h = checks.fit_size(F.lit(100.0), F.lit(50.0))
    assert tuple(spark.range(1).select(w, h).first()) == (100, 50)
    line = sinks.with_context(F.lit("x"), F.create_map(F.lit("b"), F.lit("2"), F.lit("a"), F.lit("1"), F.lit("c"), F.lit(None).cast("string")))
    assert spark.range(1).select(line).first()[0] == "x a=1 b=2"
    df = spark.createDataFrame([("<b>&" + "y" * 600, None)], "a string, b string")
    row = sinks.html_rows(df, ["a", "b"]).first()[0]
    assert row.startswith("<tr><td>&lt;b&gt;&amp;yyy") and row.endswith("…</td><td></td></tr>")
