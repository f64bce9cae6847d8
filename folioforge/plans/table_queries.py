"""Queries of the joining, deduplicating, aggregating and window operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.functions import config, sequence, similarity, text
from folioforge.operators import chunking, dedup, linkage, model, rollup
from folioforge.operators.partitioning import spread
from folioforge.plans.catalog import query
from folioforge.sources import archive, sinks
from folioforge.sources.tables import table
from folioforge.streaming import events as streams


def _parts_by_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem")
    of = lambda f: F.collect_set(F.when(F.col("l_returnflag") == f, F.col("l_partkey")))
    return rows.groupBy("l_orderkey").agg(of("R").alias("expected"), of("N").alias("actual"))


@query("""WITH g AS (SELECT l_orderkey, count(DISTINCT l_partkey) FILTER (WHERE l_returnflag = 'R') AS e, count(DISTINCT l_partkey) FILTER (WHERE l_returnflag = 'N') AS a FROM lineitem GROUP BY l_orderkey),
    h AS (SELECT l_orderkey, count(*) AS hits FROM (SELECT l_orderkey, l_partkey FROM lineitem WHERE l_returnflag = 'R' INTERSECT SELECT l_orderkey, l_partkey FROM lineitem WHERE l_returnflag = 'N') GROUP BY l_orderkey)
    SELECT l_orderkey, round(CASE WHEN e = 0 AND a = 0 THEN 1.0 WHEN e = 0 OR a = 0 THEN 0.0 ELSE coalesce(hits, 0)::DOUBLE / e END, 6) AS recall FROM g LEFT JOIN h USING (l_orderkey)""")
def q11_set_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parts_by_flag(spark, sf_dir).select("l_orderkey", F.round(similarity.recall(F.col("expected"), F.col("actual")), 6).alias("recall"))


@query("""WITH g AS (SELECT l_orderkey, list(l_returnflag ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate, l_returnflag, l_linestatus) AS a,
      list(l_linestatus ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate, l_returnflag, l_linestatus) AS b FROM lineitem GROUP BY l_orderkey)
    SELECT l_orderkey, round(list_sum([CASE WHEN a[i] = b[i] THEN 1 ELSE 0 END for i in range(1, len(a) + 1)])::DOUBLE / len(a), 6) AS score FROM
    (SELECT l_orderkey, [CASE WHEN x = 'N' THEN 'O' ELSE 'F' END for x in a] AS a, b FROM g)""")
def q12_positional_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines are few by the nature of an order, so they are listed; each list is sorted whole."""
    key = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate", "l_returnflag", "l_linestatus"]
    lists = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct(*key))).alias("r"))
    a = F.transform(F.col("r.l_returnflag"), lambda x: F.when(x == "N", "O").otherwise("F"))
    return lists.select("l_orderkey", F.round(similarity.positional(a, F.col("r.l_linestatus")), 6).alias("score"))


_CHUNK_LIMIT = 60


@query(f"""WITH RECURSIVE i AS (SELECT caption_id, panel_id, length(coalesce(panel_caption, '')) // 4 AS size, row_number() OVER (PARTITION BY caption_id ORDER BY panel_id) AS k FROM panel_list),
    c AS (SELECT caption_id, panel_id, size, k, 1 AS chunk_no, size > {_CHUNK_LIMIT} AS fresh, CASE WHEN size > {_CHUNK_LIMIT} THEN 0 ELSE size END AS open_sum FROM i WHERE k = 1
      UNION ALL SELECT i.caption_id, i.panel_id, i.size, i.k, CASE WHEN i.size > {_CHUNK_LIMIT} OR c.fresh OR c.open_sum + i.size > {_CHUNK_LIMIT} THEN c.chunk_no + 1 ELSE c.chunk_no END, i.size > {_CHUNK_LIMIT},
        CASE WHEN i.size > {_CHUNK_LIMIT} THEN 0 WHEN c.fresh OR c.open_sum + i.size > {_CHUNK_LIMIT} THEN i.size ELSE c.open_sum + i.size END FROM c JOIN i ON i.caption_id = c.caption_id AND i.k = c.k + 1)
    SELECT caption_id, panel_id, size, chunk_no FROM c""")
def q16_chunk_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "panel_list").select("caption_id", "panel_id", text.tokens(F.coalesce("panel_caption", F.lit(""))).alias("size"))
    return chunking.chunk(items, "caption_id", "panel_id", "size", _CHUNK_LIMIT)


@query("""SELECT doc_id, length(text) // 4 AS n_tokens, CASE source WHEN 'openbench-mirror' THEN 100 ELSE 400 END AS token_limit, length(text) // 4 > CASE source WHEN 'openbench-mirror' THEN 100 ELSE 400 END AS over FROM documents""")
def q17_token_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Limits by a map with a default."""
    limits = F.create_map(F.lit("openbench-mirror"), F.lit(100))
    n, most = text.tokens(F.col("text")), F.coalesce(limits[F.col("source")], F.lit(400))
    return table(spark, sf_dir, "documents").select("doc_id", n.alias("n_tokens"), most.alias("token_limit"), (n > most).alias("over"))


@query("""SELECT source, section, count(*) AS n_calls, sum(length(text) // 4)::BIGINT AS prompt_tokens, sum(n_chars // 10)::BIGINT AS completion_tokens, sum(length(text) // 4 + n_chars // 10)::BIGINT AS total_tokens,
    (grouping(source) + grouping(section))::BIGINT AS is_total FROM documents GROUP BY ROLLUP (source, section)""")
def q18_usage_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls = table(spark, sf_dir, "documents").select("source", "section", text.tokens(F.col("text")).alias("prompt_tokens"), F.floor(F.col("n_chars") / 10).alias("completion_tokens"))
    return rollup.usage_rollup(calls, ["source", "section"])


@query("""WITH d AS (SELECT registry_id, regexp_extract(sample_id, '^[A-Z]+', 0) AS prefix FROM identifiers), v AS (SELECT DISTINCT accession_number FROM data_source WHERE accession_number IS NOT NULL),
    b AS (SELECT accession_number, arg_max(registry_id, length(prefix)) AS registry_id FROM v JOIN d ON starts_with(accession_number, prefix) GROUP BY accession_number)
    SELECT data_source_id, registry_id FROM data_source LEFT JOIN b USING (accession_number)""")
def q19_longest_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    prefixes = table(spark, sf_dir, "identifiers").select("registry_id", F.regexp_extract("sample_id", "^[A-Z]+", 0).alias("prefix"))
    rows = table(spark, sf_dir, "data_source").select("data_source_id", "accession_number")
    return linkage.longest_prefix(rows, "accession_number", prefixes, "prefix", ["registry_id"]).select("data_source_id", "registry_id")


_LABEL = "coalesce(nullif(regexp_extract(upper(panel_label), '([A-Z])[0-9]*$', 1), ''), upper(panel_label))"


@query(f"""SELECT extraction_id, label, min(panel_info_id) AS place, arg_max(panel_info_id, (CASE WHEN panel_caption IS NULL THEN 0 ELSE 1 END, length(panel_caption), -panel_info_id)) AS kept
    FROM (SELECT *, {_LABEL} AS label FROM panel_info) GROUP BY extraction_id, label""")
def q25_panel_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "panel_info").select("panel_info_id", "extraction_id", text.panel_label(F.col("panel_label")).alias("label"), F.char_length("panel_caption").alias("score"))
    best = dedup.keep_best(rows, ["extraction_id", "label"], F.col("score"), F.col("panel_info_id"), place="place")
    return best.select("extraction_id", "label", "place", F.col("panel_info_id").alias("kept"))


@query("""WITH r AS (SELECT *, panel_info_id = min(panel_info_id) OVER (PARTITION BY extraction_id, panel_label) AS first FROM panel_info)
    SELECT source, count(*) FILTER (WHERE first) AS n_kept, count(*) FILTER (WHERE NOT first) AS n_duplicates FROM r GROUP BY source""")
def q26_first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "panel_info").select("panel_info_id", "extraction_id", "panel_label", "source")
    marked = dedup.first_and_rest(rows, ["extraction_id", "panel_label"], "panel_info_id")
    return marked.groupBy("source").agg(F.sum(F.col("is_first").cast("bigint")).alias("n_kept"), F.sum((~F.col("is_first")).cast("bigint")).alias("n_duplicates"))


@query("""WITH p AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings), m AS (SELECT label, i, avg(x) AS m FROM p GROUP BY ALL),
    d AS (SELECT label, vec_id, round(sum((x - m) * (x - m)), 6) AS distance FROM p JOIN m USING (label, i) GROUP BY ALL)
    SELECT label, vec_id, distance, row_number() OVER (PARTITION BY label ORDER BY distance, vec_id) = 1 AS is_winner FROM d""")
def q27_conflict_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vector nearest to the mean of its label over all 64 coordinates."""
    points = table(spark, sf_dir, "embeddings")
    return dedup.nearest_to_group(points, "label", "vec_id", [F.element_at("embedding", i) for i in range(1, 65)])


@query("""WITH l AS (SELECT chr((64 + i)::INTEGER) AS label, i AS pos FROM range(1, 27) t(i) UNION ALL SELECT chr((65 + (i - 27) // 26)::INTEGER) || chr((65 + (i - 27) % 26)::INTEGER), i FROM range(27, 703) t(i)),
    u AS (SELECT DISTINCT caption_id, upper(trim(panel_label)) AS label FROM panel_list WHERE trim(coalesce(panel_label, '')) <> ''),
    p AS (SELECT caption_id, panel_id, row_number() OVER (PARTITION BY caption_id ORDER BY panel_id) AS k FROM panel_list WHERE trim(coalesce(panel_label, '')) = ''),
    f AS (SELECT c.caption_id, l.label, row_number() OVER (PARTITION BY c.caption_id ORDER BY pos) AS k FROM (SELECT DISTINCT caption_id FROM p) c CROSS JOIN l LEFT JOIN u ON u.caption_id = c.caption_id AND u.label = l.label WHERE u.label IS NULL)
    SELECT caption_id, panel_id, coalesce(f.label, 'unknown') AS new_label FROM p LEFT JOIN f USING (caption_id, k)""")
def q28_free_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.free_labels(table(spark, sf_dir, "panel_list").select("caption_id", "panel_id", "panel_label"), "caption_id", "panel_id", "panel_label")


@query("""SELECT l_orderkey, l_linenumber + 1 AS gap_from, after - 1 AS gap_to FROM (SELECT l_orderkey, l_linenumber, lead(l_linenumber) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS after
    FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) WHERE after > l_linenumber + 1""")
def q29_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.gaps(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber"), "l_orderkey", "l_linenumber")


@query("""SELECT k AS manuscript_id, CASE WHEN l.k IS NULL THEN 'right' WHEN r.k IS NULL THEN 'left' ELSE 'both' END AS side FROM (SELECT DISTINCT manuscript_id AS k FROM caption_extraction) l
    FULL JOIN (SELECT DISTINCT manuscript_id AS k FROM data_source) r USING (k)""")
def q31_unmatched_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linkage.unmatched_kept(table(spark, sf_dir, "caption_extraction"), table(spark, sf_dir, "data_source"), ["manuscript_id"])


@query("""WITH o AS (SELECT l_orderkey, max(l_partkey) AS f FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1), n AS (SELECT l_orderkey, max(l_partkey) AS f FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1)
    SELECT l_orderkey, coalesce(n.f, o.f) AS file FROM o FULL JOIN n USING (l_orderkey)""")
def q32_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    of = lambda f: table(spark, sf_dir, "lineitem").where(F.col("l_returnflag") == f).groupBy("l_orderkey").agg(F.max("l_partkey").alias("file"))
    return linkage.upsert(of("R"), of("A"), ["l_orderkey"], ["file"])


@query("""SELECT l_orderkey, count(*) AS n_files, count(*) FILTER (WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size <= 10)) AS n_allowed FROM lineitem GROUP BY l_orderkey""")
def q33_allow_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assigned files that are allowed; orders left with none stay, with zero."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    allowed = table(spark, sf_dir, "part").where("p_size <= 10").select(F.col("p_partkey").alias("l_partkey"))
    kept = linkage.allowed_only(lines, allowed, "l_partkey").groupBy("l_orderkey").agg(F.count("*").alias("k"))
    return lines.groupBy("l_orderkey").agg(F.count("*").alias("n_files")).join(kept, "l_orderkey", "left").select("l_orderkey", "n_files", F.coalesce("k", F.lit(0)).cast("bigint").alias("n_allowed"))


@query(r"""WITH f AS (SELECT DISTINCT manuscript_id, regexp_extract(figure_label, '[0-9]+', 0) AS n FROM caption_extraction WHERE regexp_extract(figure_label, '[0-9]+', 0) <> ''),
    s AS (SELECT DISTINCT manuscript_id, regexp_extract(figure_label, '[0-9]+', 0) || 'SourceData' AS l FROM panel_info WHERE regexp_extract(figure_label, '[0-9]+', 0) <> '')
    SELECT manuscript_id, 'Figure ' || n AS label, 'Figure' || l AS path, regexp_full_match(l, n || '[^0-9].*') AS is_exact FROM f JOIN s USING (manuscript_id) WHERE starts_with(l, n)""")
def q34_source_prefix_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct figures and source labels of a manuscript, by name in the label: Figure 1 also meets Figure 10."""
    number = F.regexp_extract("figure_label", "[0-9]+", 0)
    figs = table(spark, sf_dir, "caption_extraction").select("manuscript_id", number.alias("n")).where("n <> ''").distinct().select("manuscript_id", F.concat(F.lit("Figure "), "n").alias("label"))
    named = table(spark, sf_dir, "panel_info").select("manuscript_id", number.alias("n")).where("n <> ''").distinct()
    files = named.select("manuscript_id", F.concat(F.lit("Figure "), "n", F.lit(" Source Data")).alias("label"), F.concat(F.lit("Figure"), "n", F.lit("SourceData")).alias("path"))
    loose = archive.attach_sources(figs, files, "manuscript_id", exact=False)
    exact = archive.attach_sources(figs, files, "manuscript_id").withColumn("is_exact", F.lit(True))
    return loose.join(exact, ["manuscript_id", "label", "path"], "left").select("manuscript_id", "label", "path", F.coalesce("is_exact", F.lit(False)).alias("is_exact"))


@query("""WITH c AS (SELECT record_id, docx AS path, 1 AS pri FROM manuscript_records WHERE docx IS NOT NULL UNION ALL SELECT record_id, pdf, 2 FROM manuscript_records WHERE pdf IS NOT NULL UNION ALL SELECT record_id, manuscript_id || '.tex', 3 FROM manuscript_records)
    SELECT record_id, arg_min(path, pri) AS path, min(pri) AS pri FROM c GROUP BY record_id""")
def q35_priority_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "manuscript_records").select("record_id", "manuscript_id", "docx", "pdf")
    kinds = F.array(*[F.struct(c.alias("path"), F.lit(k).alias("pri")) for k, c in enumerate((F.col("docx"), F.col("pdf"), F.concat("manuscript_id", F.lit(".tex"))), 1)])
    return linkage.by_priority(rows.select("record_id", F.inline(kinds)).where("path IS NOT NULL"), ["record_id"], "pri")


@query("""SELECT accession_number, registry_id, identifiers_pattern || accession_number AS url FROM (SELECT DISTINCT accession_number FROM data_source) JOIN identifiers
    ON regexp_full_match(accession_number, substring(local_unique_identifier_pattern, 2, length(local_unique_identifier_pattern) - 2))""")
def q36_registry_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    patterns = table(spark, sf_dir, "identifiers").select("registry_id", "identifiers_pattern", F.regexp_replace("local_unique_identifier_pattern", r"^\^|\$$", "").alias("pattern"))
    got = linkage.pattern_matches(table(spark, sf_dir, "data_source"), "accession_number", patterns, "pattern", ["registry_id", "identifiers_pattern"])
    return got.select("accession_number", "registry_id", F.concat("identifiers_pattern", "accession_number").alias("url"))


@query("""WITH c AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linestatus, l_returnflag = 'R' AS expected FROM lineitem),
    n AS (SELECT l_orderkey, count(*) FILTER (WHERE expected)::BIGINT AS n FROM c GROUP BY 1),
    k AS (SELECT l_orderkey, 1 AS field, l_partkey::VARCHAR AS v, expected FROM c UNION ALL SELECT l_orderkey, 2, l_suppkey::VARCHAR, expected FROM c UNION ALL SELECT l_orderkey, 3, l_linestatus, expected FROM c),
    m AS (SELECT l_orderkey, field, v, (count(*) FILTER (WHERE expected) * count(*) FILTER (WHERE NOT expected))::BIGINT AS pairs FROM k GROUP BY ALL), s AS (SELECT l_orderkey, sum(pairs) AS hits FROM m GROUP BY 1)
    SELECT l_orderkey, round(hits::DOUBLE / 3 / greatest(n, 1), 6) AS accuracy FROM s JOIN n USING (l_orderkey)""")
def q37_source_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean of three field matches over all pairs of expected and actual rows of an order; the
    line status, a single letter, stands for the database name. May exceed 1."""
    lines = spread(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linestatus", "l_returnflag")).withColumn("expected", F.col("l_returnflag") == "R")
    got = linkage.pair_accuracy(lines, "l_orderkey", "expected", "l_linestatus", ["l_partkey", "l_suppkey"])
    return got.select("l_orderkey", F.round("accuracy", 6).alias("accuracy"))


@query("""SELECT n_name AS model, t AS temperature, r AS run FROM nation CROSS JOIN (VALUES (0), (5)) a(t) CROSS JOIN range(1, 4) b(r) WHERE NOT EXISTS (SELECT 1 FROM region WHERE r_regionkey = n_regionkey AND r_regionkey + r = 3)""")
def q38_grid_todo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The grid of models, temperatures and runs, spread out by arrays, without the cases done."""
    cases = F.array(*[F.struct(F.lit(c["temperature"]).alias("temperature"), F.lit(c["run"]).cast("bigint").alias("run")) for c in config.grid(temperature=(0, 5), run=(1, 2, 3))])
    grid = table(spark, sf_dir, "nation").select(F.col("n_name").alias("model"), "n_regionkey", F.inline(cases))
    done = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("n_regionkey"), (3 - F.col("r_regionkey")).cast("bigint").alias("run"))
    return linkage.todo(grid, done, ["n_regionkey", "run"]).select("model", "temperature", "run")


@query("""SELECT section, lang, count(n_chars) AS n, round(avg(n_chars), 6) AS mean, round(stddev_samp(n_chars), 6) AS std, round(min(n_chars)::DOUBLE, 6) AS min, round(quantile_cont(n_chars, 0.25), 6) AS p25,
    round(quantile_cont(n_chars, 0.5), 6) AS p50, round(quantile_cont(n_chars, 0.75), 6) AS p75, round(max(n_chars)::DOUBLE, 6) AS max FROM documents GROUP BY section, lang""")
def q39_describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.describe(table(spark, sf_dir, "documents"), ["section", "lang"], F.col("n_chars"))


_OUTCOME = "CASE WHEN value > 95 THEN 'error' WHEN value > 80 THEN 'failed' ELSE 'passed' END"


@query(f"""WITH c AS (SELECT user_id, {_OUTCOME} AS o FROM events) SELECT user_id, count(*) FILTER (WHERE o = 'passed') AS n_passed, count(*) FILTER (WHERE o = 'failed') AS n_failed, count(*) FILTER (WHERE o = 'error') AS n_error,
    CASE WHEN bool_or(o = 'error') THEN 'error' WHEN bool_or(o = 'failed') THEN 'degraded' ELSE 'success' END AS status FROM c GROUP BY user_id""")
def q40_status_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.fold_status(table(spark, sf_dir, "events").select("user_id", F.expr(_OUTCOME).alias("o")), ["user_id"], "o")


@query("""WITH p AS (SELECT caption_id, panel_label FROM panel_list WHERE panel_label IS NOT NULL), n AS (SELECT caption_id, count(*) AS n FROM p GROUP BY 1)
    SELECT caption_id, n, array_to_string(list_sort(list_filter([chr((64 + i)::INTEGER) for i in range(1, least(n, 10) + 1)], lambda x: NOT list_contains(s, x))), ',') AS missing FROM n JOIN (SELECT caption_id, list(DISTINCT panel_label) AS s FROM p GROUP BY 1) USING (caption_id) WHERE n > 1""")
def q43_missing_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Letters that the number of panels lets expect, ten at most, and no panel has."""
    rows = table(spark, sf_dir, "panel_list").where("panel_label IS NOT NULL")
    wanted = F.array(*[F.lit(x) for x in sequence.LETTERS[:10]])
    got = rows.groupBy("caption_id").agg(F.count("*").alias("n"), F.collect_set(F.when(F.col("panel_label").isin(*sequence.LETTERS[:10]), F.col("panel_label"))).alias("s"))
    missing = F.array_except(F.slice(wanted, F.lit(1), F.least("n", F.lit(10)).cast("int")), F.col("s"))
    return got.where("n > 1").select("caption_id", "n", F.array_join(missing, ",").alias("missing"))


@query("""WITH b AS (SELECT vec_id, label, embedding[1] AS x1, embedding[2] AS y1, embedding[3] AS x2, embedding[4] AS y2 FROM embeddings), d AS (SELECT label, count(*) > 1 AS repeated FROM b GROUP BY label)
    SELECT count(*) AS n, count(*) FILTER (WHERE NOT (x1 BETWEEN 0 AND 1 AND y1 BETWEEN 0 AND 1 AND x2 BETWEEN 0 AND 1 AND y2 BETWEEN 0 AND 1)) AS out_of_range, count(*) FILTER (WHERE x1 > x2 OR y1 > y2) AS turned,
    count(*) FILTER (WHERE repeated) AS repeated_labels FROM b JOIN d USING (label)""")
def q45_contract_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    boxes = table(spark, sf_dir, "embeddings").select("label", *[F.element_at("embedding", k).alias(c) for k, c in enumerate(("x1", "y1", "x2", "y2"), 1)])
    inside = F.lit(True)
    for c in ("x1", "y1", "x2", "y2"):
        inside = inside & F.col(c).between(0, 1)
    by = boxes.groupBy("label").agg(F.count("*").alias("n"), F.sum((~inside).cast("bigint")).alias("bad"), F.sum(((F.col("x1") > F.col("x2")) | (F.col("y1") > F.col("y2"))).cast("bigint")).alias("turned"))
    return by.agg(F.sum("n").alias("n"), F.sum("bad").alias("out_of_range"), F.sum("turned").alias("turned"), F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0)).alias("repeated_labels"))


@query("""SELECT caption_id, n_panels, first_label, has_title FROM (SELECT c.caption_id, count(p.panel_id) AS n_panels, arg_min(p.panel_label, p.panel_id) AS first_label, any_value(caption_title) IS NOT NULL AS has_title
    FROM individual_caption c LEFT JOIN panel_list p USING (caption_id) GROUP BY c.caption_id)""")
def q47_json_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captions with their panels written as pruned JSON and read again."""
    panels = table(spark, sf_dir, "panel_list").groupBy("caption_id").agg(F.array_sort(F.collect_list(F.struct("panel_id", "panel_label"))).alias("panels"))
    rows = table(spark, sf_dir, "individual_caption").join(panels, "caption_id", "left")
    doc = sinks.pruned_json({"caption_title": F.col("caption_title")}, {"panels": F.coalesce("panels", F.array().cast("array<struct<panel_id:bigint,panel_label:string>>")), "sd_files": F.array().cast("array<string>")})
    back = rows.select("caption_id", F.from_json(doc, "caption_title string, panels array<struct<panel_id bigint, panel_label string>>, sd_files array<string>").alias("d"))
    n = F.coalesce(F.size("d.panels"), F.lit(0))
    labelled = F.filter("d.panels", lambda p: p["panel_label"].isNotNull())  # the first panel that has a label
    return back.select("caption_id", F.when(n > 0, n).otherwise(0).cast("bigint").alias("n_panels"), F.try_element_at(labelled, F.lit(1))["panel_label"].alias("first_label"), F.col("d.caption_title").isNotNull().alias("has_title"))


@query("""SELECT event_type, count(*) AS n, round(avg(CASE WHEN value > 95 THEN 1.0 ELSE 0.0 END), 6) AS error_share, round(max(value), 4) AS slowest FROM events GROUP BY event_type""")
def q48_step_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.avg(F.when(F.col("value") > 95, 1.0).otherwise(0.0)), 6).alias("error_share"), F.round(F.max("value"), 4).alias("slowest"))


@query("""SELECT date_trunc('day', ts) AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL""")
def q49_daily_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return streams.by_window(table(spark, sf_dir, "events"))


@query("""WITH e AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS starts FROM events),
    s AS (SELECT user_id, ts, sum(starts) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM e) SELECT user_id, min(ts) AS session_start, count(*) AS n FROM s GROUP BY user_id, k""")
def q50_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return streams.sessions(table(spark, sf_dir, "events"))


@query("""SELECT lang, source, count(*) AS n, sum(n_chars)::BIGINT AS n_chars, grouping(lang)::BIGINT AS all_langs, grouping(source)::BIGINT AS all_sources FROM documents GROUP BY ROLLUP (lang, source)""")
def q52_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = table(spark, sf_dir, "documents").rollup("lang", "source").agg(F.count("*").alias("n"), F.sum("n_chars").alias("n_chars"), F.grouping("lang").cast("bigint").alias("all_langs"), F.grouping("source").cast("bigint").alias("all_sources"))
    return got.select("lang", "source", "n", "n_chars", "all_langs", "all_sources")


@query("""SELECT caption_id, count(*) AS n_items, sum(length(coalesce(panel_caption, '')) // 4)::BIGINT AS total_tokens, md5(string_agg(coalesce(panel_label, ''), '|' ORDER BY panel_id)) AS labels_md5 FROM panel_list GROUP BY caption_id""")
def q53_merge_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies of a request's chunks joined in order, their usage summed."""
    rows = table(spark, sf_dir, "panel_list").select("caption_id", "panel_id", F.coalesce("panel_label", F.lit("")).alias("label"), text.tokens(F.coalesce("panel_caption", F.lit(""))).alias("t"))
    got = rows.groupBy("caption_id").agg(F.count("*").alias("n_items"), F.sum("t").alias("total_tokens"), F.array_sort(F.collect_list(F.struct("panel_id", "label"))).alias("r"))
    return got.select("caption_id", "n_items", "total_tokens", F.md5(F.array_join("r.label", "|")).alias("labels_md5"))


_XML = "concat('<article><article-id pub-id-type=\"manuscript\">', manuscript_id, '</article-id><fig object-type=\"Figure\"><label>', {0}, '</label><object_id>', manuscript_id, '/graphic/', extraction_id, '.tif</object_id></fig></article>')"


@query("""SELECT extraction_id, manuscript_id AS found_id, 1 AS figure_no, CASE WHEN regexp_replace(figure_label, '[^0-9]', '', 'g') <> '' THEN 'Figure ' || regexp_replace(figure_label, '[^0-9]', '', 'g') ELSE figure_label END AS label,
    'graphic/' || extraction_id || '.tif' AS image FROM caption_extraction WHERE NOT contains(figure_label, 'EV')""")
def q55_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifests made of caption rows, read as XML."""
    rows = table(spark, sf_dir, "caption_extraction").select("extraction_id", F.expr(_XML.format("figure_label")).alias("xml"))
    figs = archive.figures(rows.select("extraction_id", "xml"), "extraction_id", "xml")
    ids = rows.select("extraction_id", archive.manuscript_number(F.col("xml")).alias("found_id"))
    return figs.join(ids, "extraction_id").select("extraction_id", "found_id", "figure_no", "label", "image")


@query()
def q56_model_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Section replies of the stand-in model for every section row, parsed, with their usage."""
    prompts = table(spark, sf_dir, "extracted_sections").select("section_id", F.concat_ws("\nData availability: ", "figure_legends", "data_availability").alias("prompt"))
    replies = model.complete_all(prompts, "section_id", "prompt")
    parsed = F.from_json(text.json_in_reply(F.col("reply")), "figure_legends string, data_availability string")
    return replies.select(F.col("request_id").alias("section_id"), F.char_length(parsed["figure_legends"]).alias("legends_length"), F.char_length(parsed["data_availability"]).alias("availability_length"), "prompt_tokens", "completion_tokens", "attempts", "error")
