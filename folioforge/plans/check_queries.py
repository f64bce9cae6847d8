"""Queries of the check, message, set and image-arithmetic operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioforge.functions import text
from folioforge.operators import checks, chunking, dedup, linkage
from folioforge.plans.catalog import query
from folioforge.sources import sinks
from folioforge.sources.tables import table

_TAGS = {"statistics": ("p <", "p =", "anova", "t-test", "±"), "scale": ("scale bar",), "replicates": ("replicate", "independent", "n =")}
_TAG_SQL = " || ".join(f"CASE WHEN {' OR '.join(f'contains(lower(panel_caption), {chr(39)}{k}{chr(39)})' for k in words)} THEN '{name},' ELSE '' END" for name, words in _TAGS.items())


@query("""WITH c AS (SELECT caption_id, panel_id, panel_label, row_number() OVER (PARTITION BY caption_id ORDER BY panel_id) AS k FROM panel_list) SELECT caption_id, panel_id FROM c
    WHERE k <= 2 AND upper(panel_label) IN ('A', 'B')""")
def q41_label_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two first panels of a caption, if their label is an expected one."""
    rows = table(spark, sf_dir, "panel_list").select("caption_id", "panel_id", "panel_label")
    ranked = rows.withColumn("k", F.row_number().over(Window.partitionBy("caption_id").orderBy("panel_id"))).where("k <= 2")
    expected = spark.createDataFrame([("A",), ("B",)], "label string")
    return linkage.allowed_only(ranked.withColumn("label", F.upper("panel_label")), expected, "label").select("caption_id", "panel_id")


@query("SELECT caption_id, panel_id FROM panel_list WHERE upper(panel_label) IN ('A', 'B') AND caption_id IS NOT NULL OR NOT EXISTS (SELECT 1 FROM individual_caption c WHERE c.caption_id = panel_list.caption_id)")
def q41b_expected_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All panels of a caption whose label is an expected one; captions unknown have no list and keep all."""
    rows = table(spark, sf_dir, "panel_list").select("caption_id", "panel_id", F.upper("panel_label").alias("label"))
    expected = table(spark, sf_dir, "individual_caption").select("caption_id", F.explode(F.array(F.lit("A"), F.lit("B"))).alias("label"))
    return linkage.expected_only(rows, expected, "caption_id", "label").select("caption_id", "panel_id")


@query(f"SELECT tags, count(*) AS n FROM (SELECT {_TAG_SQL} AS tags FROM panel_info WHERE panel_caption IS NOT NULL) GROUP BY tags")
def q42_keyword_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = checks.keyword_rules(F.col("panel_caption"), _TAGS)
    tags = F.when(F.size(found) > 0, F.concat(F.array_join(found, ","), F.lit(","))).otherwise("")
    return table(spark, sf_dir, "panel_info").where("panel_caption IS NOT NULL").groupBy(tags.alias("tags")).agg(F.count("*").alias("n"))


@query("""WITH i AS (SELECT event_type, value > 95 AS critical, value > 80 AS issue FROM events), s AS (SELECT event_type, count(*) FILTER (WHERE critical) AS n_critical, count(*) FILTER (WHERE issue) AS n_issues FROM i GROUP BY event_type)
    SELECT event_type, n_critical, n_issues, CASE WHEN n_critical > 0 THEN 'critical' WHEN n_issues > 10 THEN 'review' ELSE 'good' END AS advice FROM s""")
def q44_issue_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = table(spark, sf_dir, "events").groupBy("event_type").agg(F.count_if(F.col("value") > 95).alias("n_critical"), F.count_if(F.col("value") > 80).alias("n_issues"))
    return got.withColumn("advice", F.when(F.col("n_critical") > 0, "critical").when(F.col("n_issues") > 10, "review").otherwise("good"))


_CHECKS = [("stat_test", "panel"), ("error_bars", "panel"), ("layout", "figure"), ("ethics", "document")]
_CHECK_SQL = "(VALUES " + ", ".join(f"('{n}', '{lv}')" for n, lv in _CHECKS) + ") c(check_name, level)"


@query(f"""WITH f AS (SELECT caption_id, manuscript_id, caption_id = min(caption_id) OVER (PARTITION BY manuscript_id) AS first FROM individual_caption)
    SELECT caption_id, check_name, level FROM f JOIN {_CHECK_SQL} ON level <> 'document' OR first""")
def q58_fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Figures by checks; checks of the document run once, with its first figure."""
    rows = table(spark, sf_dir, "individual_caption").select("caption_id", "manuscript_id")
    figures = dedup.first_and_rest(rows, ["manuscript_id"], "caption_id")
    return checks.fan_out(figures, spark.createDataFrame(_CHECKS, "check_name string, level string")).select("caption_id", "check_name", "level")


@query("""WITH r AS (SELECT user_id, coalesce(nullif(trim(CASE WHEN event_id % 5 = 0 THEN ' ' ELSE event_type END), ''), 'unknown') AS part, 'check' || event_id % 3 AS check_name, value <= 80 AS passed FROM events)
    SELECT user_id, part, count(*) AS n_checks, count(*) FILTER (WHERE passed) AS n_passed, coalesce(array_to_string(list_sort(list(DISTINCT check_name) FILTER (WHERE NOT passed)), ','), '') AS failed FROM r GROUP BY ALL""")
def q59_group_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = F.when(F.col("event_id") % 5 == 0, " ").otherwise(F.col("event_type"))
    rows = table(spark, sf_dir, "events").select("user_id", part.alias("part"), F.concat(F.lit("check"), F.col("event_id") % 3).alias("check_name"), (F.col("value") <= 80).alias("passed"))
    return checks.results_by_subject(rows, "user_id", "part", "check_name", "passed")


@query("""SELECT event_id, 'done event_type=' || event_type || ' user_id=' || user_id AS line FROM events""")
def q60_context_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log line with its context, keys in order."""
    context = F.create_map(F.lit("user_id"), F.col("user_id").cast("string"), F.lit("event_type"), F.col("event_type"))
    return table(spark, sf_dir, "events").select("event_id", sinks.with_context(F.lit("done"), context).alias("line"))


@query("""SELECT registry_id, count(*)::BIGINT AS n_lines FROM identifiers, range(0, 40) GROUP BY registry_id""")
def q61_chunk_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompts with a long list taken apart into prompts of a token limit; no line is lost."""
    lines = F.transform(F.sequence(F.lit(0), F.lit(39)), lambda k: F.concat("name", F.lit(" file "), k.cast("string")))
    prompts = table(spark, sf_dir, "identifiers").select("registry_id", F.concat(F.lit("Assign the files.\nFiles:\n"), F.array_join(lines, "\n")).alias("prompt"))
    parts = chunking.chunk_prompts(prompts, "registry_id", "prompt", "Files:", 150)
    return parts.groupBy("registry_id").agg(F.sum("n_lines").alias("n_lines"))


@query("""SELECT manuscript_id FROM (SELECT manuscript_id FROM data_source INTERSECT SELECT manuscript_id FROM caption_extraction) EXCEPT SELECT manuscript_id FROM extracted_sections""")
def q62_set_operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = lambda t: table(spark, sf_dir, t).select("manuscript_id")
    return ids("data_source").intersect(ids("caption_extraction")).subtract(ids("extracted_sections"))


@query("""SELECT caption_id, 2 AS n_parts, 'image/png' AS mime, length(coalesce(figure_caption, '')) AS text_length FROM individual_caption""")
def q63_message_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of a text and an image part: counted, their image URL taken apart, their text measured."""
    url = F.concat(F.lit("data:image/png;base64,"), F.base64(F.encode(F.col("caption_id").cast("string"), "UTF-8")))
    parts = F.array(F.struct(F.lit("text").alias("type"), F.coalesce("figure_caption", F.lit("")).alias("content")), F.struct(F.lit("image_url").alias("type"), url.alias("content")))
    rows = table(spark, sf_dir, "individual_caption").select("caption_id", parts.alias("parts"))
    image = F.get(F.filter("parts", lambda p: p["type"] == "image_url"), F.lit(0))["content"]
    words = F.aggregate(F.filter("parts", lambda p: p["type"] == "text"), F.lit(0), lambda n, p: n + F.char_length(p["content"]))
    return rows.select("caption_id", F.size("parts").alias("n_parts"), text.data_url_parts(image)["mime"].alias("mime"), words.cast("bigint").alias("text_length"))


@query("""SELECT event_id, CASE WHEN event_id % 3 = 2 THEN 0 ELSE 1 END AS n_outputs, CASE WHEN event_id % 3 = 2 THEN 'k' ELSE '' END AS missing FROM events""")
def q64_wrapped_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies with an outputs array, bare or broken, read as one; fields that are missing."""
    m = F.col("event_id") % 3
    reply = F.when(m == 0, F.concat(F.lit('{"outputs": ['), "props", F.lit("]}"))).when(m == 1, F.col("props")).otherwise("{broken")
    rows = table(spark, sf_dir, "events").select("event_id", reply.alias("reply"), F.when(m == 2, F.lit("{broken")).otherwise(F.col("props")).alias("flat"))
    return rows.select("event_id", F.size(checks.wrap_outputs(F.col("reply"), "struct<k:bigint>")).alias("n_outputs"), F.array_join(checks.required_fields(F.col("flat"), ["k"]), ",").alias("missing"))


@query("""SELECT manuscript_id FROM (SELECT DISTINCT manuscript_id FROM caption_extraction) ORDER BY manuscript_id LIMIT 25""")
def q65_first_manuscripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 25 manuscripts by id: a selector, so the limit is the feature."""
    return table(spark, sf_dir, "caption_extraction").select("manuscript_id").distinct().orderBy("manuscript_id").limit(25)


@query("""SELECT o.source, min(doc_id) AS first_doc, row_number() OVER (ORDER BY min(doc_id)) AS place FROM documents o GROUP BY o.source""")
def q66_distinct_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct sources in the order in which they first occur; one row a source is numbered."""
    firsts = table(spark, sf_dir, "documents").groupBy("source").agg(F.min("doc_id").alias("first_doc"))
    return firsts.withColumn("place", F.row_number().over(Window.orderBy("first_doc")))


@query("""SELECT c.caption_id, coalesce(any_value(s.figure_legends), 'Figure caption not found.') = 'Figure caption not found.' AS is_default FROM individual_caption c LEFT JOIN
    (SELECT manuscript_id, arg_max(figure_legends, (extracted_at, section_id)) AS figure_legends FROM (SELECT * FROM extracted_sections WHERE figure_legends IS NOT NULL) GROUP BY manuscript_id) s USING (manuscript_id) GROUP BY c.caption_id""")
def q67_default_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    sections = table(spark, sf_dir, "extracted_sections").where("figure_legends IS NOT NULL").select("manuscript_id", "extracted_at", "section_id", "figure_legends")
    legends = dedup.latest(sections, ["manuscript_id"], "extracted_at", "section_id").select("manuscript_id", "figure_legends")
    rows = table(spark, sf_dir, "individual_caption").select("caption_id", "manuscript_id").join(legends, "manuscript_id", "left")
    default = F.lit("Figure caption not found.")
    return rows.select("caption_id", (F.coalesce("figure_legends", default) == default).alias("is_default"))


@query("""WITH q AS (SELECT DISTINCT 'figure_' || regexp_extract(figure_label, '[0-9]+', 0) AS id, manuscript_id FROM panel_info), k AS (SELECT manuscript_id, id, upper(id[1]) || replace(id[2:], '_', ' ') AS label FROM q)
    SELECT k.manuscript_id, k.id, count(*) AS n FROM k JOIN caption_extraction c ON c.manuscript_id = k.manuscript_id AND c.figure_label = k.label GROUP BY ALL""")
def q68_transformed_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results under ids like figure_3 joined to figures labelled Figure 3."""
    ids = table(spark, sf_dir, "panel_info").select("manuscript_id", F.concat(F.lit("figure_"), F.regexp_extract("figure_label", "[0-9]+", 0)).alias("id")).distinct()
    keyed = ids.withColumn("figure_label", F.initcap(F.replace("id", F.lit("_"), F.lit(" "))))
    captions = table(spark, sf_dir, "caption_extraction").groupBy("manuscript_id", "figure_label").agg(F.count("*").alias("n"))
    return keyed.join(captions, ["manuscript_id", "figure_label"]).select("manuscript_id", "id", "n")


_SIDES = "(1000 + p_partkey * 37 % 30000)::DOUBLE AS width, (800 + p_partkey * 53 % 20000)::DOUBLE AS height"


@query(f"""WITH s AS (SELECT p_partkey, {_SIDES} FROM part), a AS (SELECT p_partkey, width, height, least(1.0, sqrt(178956970.0 / (width * height))) AS f FROM s),
    b AS (SELECT p_partkey, floor(width * f) AS w, floor(height * f) AS h FROM a), c AS (SELECT p_partkey, w, h, least(1.0, 2048.0::DOUBLE / greatest(w, h)) AS g FROM b)
    SELECT p_partkey, floor(w * g)::INTEGER AS width, floor(h * g)::INTEGER AS height, floor(floor(w * g) * 0.25)::INTEGER AS left_edge, floor(floor(h * g) * 0.75)::INTEGER AS lower_edge FROM c""")
def q69_image_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes brought under the pixel count and the longest side; a box in pixels."""
    k = F.col("p_partkey")
    w, h = checks.fit_size((1000 + k * 37 % 30000).cast("double"), (800 + k * 53 % 20000).cast("double"))
    sized = table(spark, sf_dir, "part").select("p_partkey", w.alias("width"), h.alias("height"))
    box = checks.to_pixels([F.lit(0.25), F.lit(0.25), F.lit(0.75), F.lit(0.75)], F.col("width"), F.col("height"))
    return sized.select("p_partkey", "width", "height", box[0].alias("left_edge"), box[3].alias("lower_edge"))


@query("""SELECT label, vec_id, confidence FROM (SELECT label, vec_id, confidence, row_number() OVER (PARTITION BY label ORDER BY confidence DESC, vec_id) AS k FROM
    (SELECT label, vec_id, round(abs(embedding[5])::DOUBLE, 6) AS confidence FROM embeddings) WHERE confidence >= 0.02) WHERE k <= 30""")
def q70_top_detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detections over a threshold, the thirty surest of each label: a top-k report."""
    rows = table(spark, sf_dir, "embeddings").select("label", "vec_id", F.round(F.abs(F.element_at("embedding", 5)).cast("double"), 6).alias("confidence")).where("confidence >= 0.02")
    k = F.row_number().over(Window.partitionBy("label").orderBy(F.desc("confidence"), "vec_id"))
    return rows.withColumn("k", k).where("k <= 30").drop("k")
