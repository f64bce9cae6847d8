import json
import zipfile

from pyspark.sql import functions as F

from folioforge.sources import archive, sinks

XML = """<?xml version="1.0"?><article><article-id pub-id-type="manuscript">AB-2024-1</article-id>
<fig object-type="Figure"><label>Fig 1</label><object_id>AB-2024-1/graphic/F1.tif</object_id></fig>
<fig object-type="Figure"><label>Figure EV2</label><object_id>AB-2024-1/graphic/EV2.tif</object_id></fig>
<fig object-type="Figure"><label>Figure 10</label><object_id>AB-2024-1/graphic/F10.tif</object_id></fig>
<form object-type="Figure Source Data Files"><label>Figure 1 Source Data</label><object_id>AB-2024-1/sd1.zip</object_id></form>
<form object-type="Figure Source Data Files"><label>Figure 10 Source Data</label><object_id>AB-2024-1/sd10.zip</object_id></form></article>"""


def make(path, members):
    with zipfile.ZipFile(path, "w") as z:
        for name, content in members.items():
            z.writestr(name, content)


def test_archives(spark, tmp_path):
    make(tmp_path / "good.zip", {"AB-2024-1.xml": XML, "AB-2024-1/Doc/text.docx": "x", "__MACOSX/y": "", "AB-2024-1/": ""})
    make(tmp_path / "bare.zip", {"a.txt": "x"})
    make(tmp_path / "empty.zip", {})
    (tmp_path / "broken.zip").write_bytes(b"no archive")
    rows = archive.read_archives(spark, str(tmp_path)).cache()
    errors = {r.archive.rsplit("/", 1)[-1]: r.error for r in rows.where("error IS NOT NULL").collect()}
    assert errors["bare.zip"] == "no manifest" and errors["empty.zip"] == "empty archive" and errors["broken.zip"].startswith("unreadable")
    good = rows.where("manuscript_id = 'AB-2024-1'")
    assert {r.member for r in archive.data_members(good).collect()} == {"AB-2024-1.xml", "Doc/text.docx"}
    one = good.where("manifest IS NOT NULL").select("manuscript_id", "manifest")
    assert one.count() == 1
    assert one.select(archive.manuscript_number(F.col("manifest"))).first()[0] == "AB-2024-1"
    figs = archive.figures(one, "manuscript_id", "manifest")
    assert [r.label for r in figs.orderBy("figure_no").collect()] == ["Figure 1", "Figure 10"]
    files = archive.source_files(one, "manuscript_id", "manifest")
    exact = {(r.label, r.path) for r in archive.attach_sources(figs, files, "manuscript_id").collect()}
    assert exact == {("Figure 1", "sd1.zip"), ("Figure 10", "sd10.zip")}
    loose = {(r.label, r.path) for r in archive.attach_sources(figs, files, "manuscript_id", exact=False).collect()}
    assert loose == exact | {("Figure 1", "sd10.zip")}


def test_elements_that_lack_something_shift_nothing(spark):
    xml = """<a><article-id pub-id-type="manuscript">M</article-id><!-- <fig object-type="Figure"><label>no</label></fig> -->
    <fig object-type="Figure"><object_id>M/one.tif</object_id></fig><fig object-type="Other"><label>Figure 9</label></fig><deep><fig id="x" object-type="Figure"><label>Figure 2</label><object_id/></fig></deep>
    <fig object-type="Figure"><label>Figure <!-- no -->3</label><object_id>M/three.tif</object_id><object_id>M/four.tif</object_id></fig><fig object-type="Figure"/></a>"""
    got = archive.figures(spark.createDataFrame([(1, xml)], "i int, x string"), "i", "x").orderBy("figure_no").collect()
    assert [(r.figure_no, r.label, r.image) for r in got] == [(1, None, "one.tif"), (3, "Figure 2", None), (4, "Figure 3", "three.tif")]


def test_no_xml_gives_no_figures(spark):
    df = spark.createDataFrame([(1, "not xml"), (2, None), (3, "")], "i int, x string")
    assert archive.figures(df, "i", "x").count() == 0


def test_json_leaves_out_what_is_empty(spark, tmp_path):
    df = spark.range(1).select(F.lit(None).cast("string").alias("t"), F.array().cast("array<string>").alias("e"))
    text = df.select(sinks.pruned_json({"title": F.col("t"), "n": F.lit(1)}, {"panels": F.col("e"), "sd_files": F.col("e")})).first()[0]
    assert json.loads(text) == {"n": 1, "sd_files": []}
    sinks.append_results(df.select("t"), str(tmp_path / "r"))
    sinks.append_results(df.select("t"), str(tmp_path / "r"))
    assert spark.read.parquet(str(tmp_path / "r")).count() == 2
