"""Queries of the manifest, panel-conflict, score and reply operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.functions import replies
from folioforge.operators import panels, scores
from folioforge.plans.catalog import query
from folioforge.sources import archive
from folioforge.sources.tables import table

_BASE = "regexp_replace({0}, '^.*/', '')"


@query(f"""WITH r AS (SELECT record_id, manuscript_id, CASE WHEN docx IS NOT NULL THEN 'Doc/' || {_BASE.format("docx")} END AS named, CASE WHEN pdf IS NOT NULL THEN {_BASE.format("pdf")} END AS pdf FROM manuscript_records),
    d AS (SELECT *, CASE WHEN lower(named) LIKE '%.docx' AND record_id % 3 <> 0 THEN named WHEN record_id % 2 = 0 THEN 'pdf/m.pdf' WHEN record_id % 5 = 0 THEN 'doc/m.tex' END AS document FROM r)
    SELECT record_id, manuscript_id, document, CASE WHEN document IS NULL THEN 'none' WHEN document = 'pdf/m.pdf' THEN 'pdf' WHEN document = 'doc/m.tex' THEN 'tex' ELSE 'docx' END AS kind, pdf,
        CASE WHEN record_id % 4 = 0 THEN 'Doc/a.pdf,Doc/b.pdf' ELSE '' END AS appendix, CASE WHEN document IS NULL AND pdf IS NULL THEN 'no manuscript file' END AS error,
        '1:-:i1.tif:|2:Figure 2:i2.tif:s2.zip,s22.zip|4:Figure 4:-:' AS figures FROM d""")
def q73_manuscript_structure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifests with a figure without a label, one without an image and an expanded-view one."""
    r = table(spark, sf_dir, "manuscript_records").select("record_id", "manuscript_id", F.concat(F.lit("Doc/"), F.regexp_replace("docx", "^.*/", "")).alias("named"), F.regexp_replace("pdf", "^.*/", "").alias("pdf_name"))
    own = lambda *parts: F.concat(F.lit("<object_id>"), F.col("manuscript_id"), F.lit("/"), *parts, F.lit("</object_id>"))
    fig = lambda label, image: F.concat(F.lit('<fig object-type="Figure">'), F.lit(f"<label>{label}</label>" if label else ""), own(F.lit(image)) if image else F.lit("<object_id/>"), F.lit("</fig>"))
    form = lambda kind, label, *files: F.concat(F.lit(f'<form object-type="{kind}"><label>{label}</label>'), *[own(F.lit(f)) for f in files], F.lit("</form>"))
    xml = F.concat(
        F.lit('<article><article-id pub-id-type="manuscript">'), F.col("manuscript_id"), F.lit("</article-id><body><!-- <fig><label>x</label></fig> -->"),
        F.when(F.col("named").isNotNull(), F.concat(F.lit('<supplementary-material object-type="Manuscript Text">'), own(F.col("named")), F.lit("</supplementary-material>"))).otherwise(""),
        F.when(F.col("pdf_name").isNotNull(), F.concat(F.lit('<merged_pdf object-type="Merged PDF">'), own(F.col("pdf_name")), F.lit("</merged_pdf>"))).otherwise(""),
        fig("", "i1.tif"), fig("Fig. 2", "i2.tif"), fig("Figure EV1", "ev.tif"), fig("Figure 4", ""), form(archive.SOURCE_DATA, "Figure 2 Source Data", "s2.zip"), form(archive.SOURCE_DATA, "Fig 22 Source Data", "s22.zip"),
        F.when(F.col("record_id") % 4 == 0, F.concat(form(archive.EXPANDED_VIEW, "Appendix", "Doc/a.pdf", "Doc/x.pdf"), form(archive.EXPANDED_VIEW, "Appendix", "Doc/b.pdf"), form(archive.EXPANDED_VIEW, "Peer Review File", "Doc/c.pdf"))).otherwise(""),
        F.lit("</body></article>"),
    )
    here = F.array_compact(F.array(F.when(F.col("record_id") % 3 != 0, F.col("named")), F.when(F.col("record_id") % 2 == 0, F.lit("pdf/m.pdf")), F.when(F.col("record_id") % 5 == 0, F.lit("doc/m.tex")), F.lit("doc/deep/er.rtf")))
    got = archive.structures(r.select("record_id", xml.alias("xml")), r.select("record_id", F.explode(here).alias("member")), "record_id", "xml")
    shown = F.transform("figures", lambda f: F.concat_ws(":", f["figure_no"].cast("string"), F.coalesce(f["label"], F.lit("-")), F.coalesce(f["image"], F.lit("-")), F.array_join(f["sd_files"], ",")))
    return got.select("record_id", "manuscript_id", "document", "kind", "pdf", F.array_join("appendix", ",").alias("appendix"), "error", F.array_join(shown, "|").alias("figures"))


_MATCHES = """m AS (SELECT 'F' || vec_id % 41 AS figure, vec_id AS detection_idx, CASE WHEN vec_id % 3 = 0 THEN lower(chr((65 + vec_id // 41 % 5)::INTEGER)) ELSE chr((65 + vec_id // 41 % 5)::INTEGER) END AS panel_label, 'found ' || vec_id AS panel_caption,
        embedding[1]::DOUBLE AS x1, embedding[2]::DOUBLE AS y1, embedding[3]::DOUBLE AS x2, embedding[4]::DOUBLE AS y2, round(abs(embedding[5])::DOUBLE, 2) AS confidence FROM embeddings),
    o AS (SELECT 'F' || vec_id % 41 AS figure, vec_id AS place, chr((65 + vec_id // 41 % 7)::INTEGER) AS panel_label, 'known ' || vec_id AS panel_caption, vec_id % 10 = 5 AS boxed,
        embedding[6]::DOUBLE AS x1, embedding[7]::DOUBLE AS y1, embedding[8]::DOUBLE AS x2, embedding[9]::DOUBLE AS y2 FROM embeddings WHERE vec_id % 5 = 0)"""


def _matches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Vectors as detections and, every fifth, as known panels; every tenth of these without a box."""
    rows = table(spark, sf_dir, "embeddings")
    k = F.col("vec_id")
    figure = F.concat(F.lit("F"), k % 41).alias("figure")
    letter = lambda n: F.char(F.floor(k / 41) % n + 65)
    box = lambda start, shown: [F.when(shown, F.element_at("embedding", start + i).cast("double")).alias(c) for i, c in enumerate(panels.BOX)]
    label = F.when(k % 3 == 0, F.lower(letter(5))).otherwise(letter(5))
    found = rows.select(figure, k.alias("detection_idx"), label.alias("panel_label"), F.concat(F.lit("found "), k).alias("panel_caption"), *box(1, F.lit(True)), F.round(F.abs(F.element_at("embedding", 5)).cast("double"), 2).alias("confidence"))
    known = rows.where("vec_id % 5 = 0").select(figure, k.alias("place"), letter(7).alias("panel_label"), F.concat(F.lit("known "), k).alias("panel_caption"), *box(6, k % 10 == 5))
    return found, known


@query(f"""WITH {_MATCHES}, k AS (SELECT figure, upper(panel_label) AS key, arg_max(panel_label, place) AS label, arg_max(panel_caption, place) AS caption, arg_max(boxed, place) AS boxed, arg_max((x1 + x2) / 2, place) AS cx, arg_max((y1 + y2) / 2, place) AS cy FROM o GROUP BY ALL),
    j AS (SELECT m.*, upper(panel_label) AS key, k.label, k.caption, CASE WHEN k.boxed THEN ((x1 + x2) / 2 - cx) * ((x1 + x2) / 2 - cx) + ((y1 + y2) / 2 - cy) * ((y1 + y2) / 2 - cy) END AS apart FROM m LEFT JOIN k ON k.figure = m.figure AND k.key = upper(panel_label)),
    w AS (SELECT *, row_number() OVER (PARTITION BY figure, key ORDER BY apart, confidence DESC, detection_idx) AS place, first(panel_label) OVER (PARTITION BY figure, key ORDER BY detection_idx) AS first_label FROM j)
    SELECT figure, coalesce(label, first_label) AS panel_label, coalesce(caption, panel_caption) AS panel_caption, round(x1, 6) AS x1, confidence, CASE WHEN label IS NULL THEN 'new' ELSE 'matched' END AS origin FROM w WHERE place = 1
    UNION ALL SELECT figure, arg_min(panel_label, place), arg_min(panel_caption, place), NULL, NULL, 'original' FROM o WHERE NOT EXISTS (SELECT 1 FROM m WHERE m.figure = o.figure AND upper(m.panel_label) = upper(o.panel_label)) GROUP BY figure, upper(panel_label)""")
def q74_panel_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = panels.resolve(*_matches(spark, sf_dir))
    return got.select("figure", "panel_label", "panel_caption", F.round("x1", 6).alias("x1"), "confidence", "origin")


@query(f"""WITH {_MATCHES} SELECT figure, upper(panel_label) AS panel_label, count(*) - 1 AS n_lost FROM m GROUP BY ALL HAVING count(*) > 1""")
def q74b_lost_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many detections lost each label."""
    return panels.conflicts(*_matches(spark, sf_dir)).groupBy("figure", F.upper("panel_label").alias("panel_label")).agg(F.count("*").alias("n_lost"))


def _files(spark: SparkSession, sf_dir: str, flag: str) -> DataFrame:
    """Parts of an order by status as the files of a panel; an order's lines are few."""
    rows = table(spark, sf_dir, "lineitem").where(F.col("l_returnflag") == flag)
    return rows.groupBy(F.col("l_orderkey").alias("figure"), F.col("l_linestatus").alias("panel")).agg(F.collect_list("l_partkey").alias("files"))


@query("""WITH e AS (SELECT l_orderkey AS figure, l_linestatus AS panel, list(l_partkey) AS files FROM lineitem WHERE l_returnflag = 'R' GROUP BY ALL), a AS (SELECT l_orderkey AS figure, l_linestatus AS panel, list(l_partkey) AS files FROM lineitem WHERE l_returnflag = 'A' GROUP BY ALL)
    SELECT e.figure, e.panel, round(CASE WHEN a.files IS NULL THEN 0.0 ELSE len(list_intersect(e.files, a.files))::DOUBLE / len(e.files) END, 6) AS score FROM e LEFT JOIN a USING (figure, panel) WHERE e.figure IN (SELECT figure FROM a)""")
def q75_panel_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of returned lines against those of accepted ones, of orders that have any of these."""
    got = scores.panel_scores(_files(spark, sf_dir, "R"), _files(spark, sf_dir, "A"), found_figures_only=True)
    return got.select("figure", "panel", F.round("score", 6).alias("score"))


@query("""WITH e AS (SELECT l_orderkey AS figure, l_linestatus AS panel, list(l_partkey) AS files FROM lineitem WHERE l_returnflag = 'R' GROUP BY ALL), a AS (SELECT l_orderkey AS figure, l_linestatus AS panel, list(l_partkey) AS files FROM lineitem WHERE l_returnflag = 'A' GROUP BY ALL)
    SELECT e.figure, round(avg(CASE WHEN a.files IS NULL THEN 0.0 ELSE len(list_intersect(e.files, a.files))::DOUBLE / len(e.files) END), 6) AS score FROM e LEFT JOIN a USING (figure, panel) GROUP BY e.figure""")
def q75b_mean_panel_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = scores.panel_scores(_files(spark, sf_dir, "R"), _files(spark, sf_dir, "A"))
    return got.groupBy("figure").agg(F.round(F.avg("score"), 6).alias("score"))


_WORDS = "list_distinct(list_filter(regexp_split_to_array({0}, '\\s+'), lambda w: w <> ''))"
_ALIKE = "(CASE WHEN len({0}) = 0 AND len({1}) = 0 THEN 1.0 ELSE len(list_intersect({0}, {1}))::DOUBLE / len(list_distinct(list_concat({0}, {1}))) END)"


@query(f"""WITH s AS (SELECT data_source_id, manuscript_id, data_source_id % 3 = 0 AS expected, lower(trim(coalesce(database, ''))) AS d, lower(trim(coalesce(accession_number, ''))) AS n FROM data_source),
    w AS (SELECT *, {_WORDS.format("d")} AS dw, {_WORDS.format("n")} AS nw FROM s),
    p AS (SELECT e.data_source_id, e.manuscript_id, coalesce(max(CASE WHEN a.d = e.d AND a.n = e.n THEN 1.0 WHEN a.d IS NOT NULL THEN 0.0 END), 0) AS exact, coalesce(max({_ALIKE.format("e.dw", "a.dw")} / 2 + {_ALIKE.format("e.nw", "a.nw")} / 2) FILTER (WHERE a.d IS NOT NULL), 0) AS likeness
          FROM w e LEFT JOIN w a ON a.manuscript_id = e.manuscript_id AND NOT a.expected WHERE e.expected GROUP BY ALL),
    g AS (SELECT manuscript_id, avg(exact) AS exact, avg(likeness) AS likeness FROM p GROUP BY ALL UNION ALL SELECT DISTINCT manuscript_id, 0.0, 0.0 FROM s WHERE manuscript_id NOT IN (SELECT manuscript_id FROM s WHERE expected))
    SELECT manuscript_id, round(exact, 6) AS exact, round(likeness, 6) AS likeness, round((exact + likeness) / 2, 6) AS score FROM g""")
def q76_source_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third data source of a manuscript as expected, the others as actual."""
    rows = table(spark, sf_dir, "data_source").select("data_source_id", "manuscript_id", "database", "accession_number")
    got = scores.source_scores(rows.where("data_source_id % 3 = 0"), rows.where("data_source_id % 3 <> 0"), "manuscript_id")
    return got.select("manuscript_id", *[F.round(c, 6).alias(c) for c in ("exact", "likeness", "score")])


@query("""SELECT event_id, CASE WHEN event_id % 4 = 3 THEN '' ELSE event_type END AS legends, CASE WHEN event_id % 4 IN (1, 3) THEN 0 ELSE 2 END AS n_sources, CASE WHEN event_id % 4 = 2 THEN 1 ELSE 0 END AS n_assigned FROM events""")
def q77_default_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies fenced, bare, broken or of the wrong shape, read with their defaults."""
    m = F.col("event_id") % 4
    given = F.when(m == 2, F.lit(', "assigned_files": [{"panel_label": "A", "panel_sd_files": ["x"]}]')).otherwise("")
    body = F.concat(F.lit('{"figure_legends": "'), F.col("event_type"), F.lit('",\n"data_availability": "d"'), given, F.lit("}"))
    reply = F.when(m == 0, F.concat(F.lit("Here:\n```json\n"), body, F.lit("\n```"))).when(m == 3, F.lit("{broken")).otherwise(body)
    listed = F.when(m == 0, F.lit('```json\n[{"database": "x"}, {"url": "y"}]\n```')).when(m == 2, F.lit('So: [{"database": "x"}, {}] it is')).otherwise(F.lit("none"))
    rows = table(spark, sf_dir, "events").select("event_id", reply.alias("r"), listed.alias("l"))
    return rows.select("event_id", replies.sections(F.col("r"))["figure_legends"].alias("legends"), F.size(replies.sources(F.col("l"))).alias("n_sources"), F.size(replies.files(F.col("r"))["assigned_files"]).alias("n_assigned"))


@query("""SELECT caption_id, string_agg(CASE WHEN panel_id % 5 <> 0 THEN coalesce(panel_label, '?') || '=f' || panel_id END, ',' ORDER BY panel_id) AS assigned, coalesce(string_agg(CASE WHEN panel_id % 5 <> 0 AND panel_id % 2 = 0 THEN 'n' || panel_id END, ',' ORDER BY panel_id), '') AS left_over,
    sum(panel_id)::BIGINT AS prompt_tokens, count(*) AS completion_tokens, sum(panel_id + 1)::BIGINT AS total_tokens FROM panel_list GROUP BY caption_id HAVING count(*) FILTER (WHERE panel_id % 5 <> 0) > 0""")
def q78_merged_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each panel as the reply to one chunk of its caption's request, every fifth unreadable."""
    k = F.col("panel_id").cast("string")
    label = F.to_json(F.struct(F.coalesce("panel_label", F.lit("?")).alias("panel_label"), F.array(F.concat(F.lit("f"), k)).alias("panel_sd_files")))
    left = F.when(F.col("panel_id") % 2 == 0, F.concat(F.lit('"n'), k, F.lit('"'))).otherwise("")
    reply = F.when(F.col("panel_id") % 5 == 0, "no answer").otherwise(F.concat(F.lit('{"assigned_files": ['), label, F.lit('], "not_assigned_files": ['), left, F.lit("]}")))
    chunks = table(spark, sf_dir, "panel_list").select("caption_id", "panel_id", reply.alias("reply"), F.col("panel_id").alias("prompt_tokens"), F.lit(1).cast("bigint").alias("completion_tokens"), (F.col("panel_id") + 1).alias("total_tokens"))
    got = replies.merge_files(chunks, "caption_id", "panel_id", "reply").where(F.size("assigned_files") > 0)
    shown = F.transform("assigned_files", lambda a: F.concat_ws("=", a["panel_label"], F.array_join(a["panel_sd_files"], "+")))
    return got.select("caption_id", F.array_join(shown, ",").alias("assigned"), F.array_join("not_assigned_files", ",").alias("left_over"), "prompt_tokens", "completion_tokens", "total_tokens")
