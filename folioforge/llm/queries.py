"""Queries of the text operators, each over its whole tables with its production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.llm import leakage, normalize, packing, registry_match, spam, splitting, truncation
from folioforge.session import materialize
from folioforge.sources.tables import table


def _cut_captions(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "caption_extraction").select(F.lit("caption_extraction").alias("table_name"), F.col("extraction_id").alias("row_id"), "source", F.col("figure_caption").alias("text"))
    b = table(spark, sf_dir, "panel_info").select(F.lit("panel_info").alias("table_name"), F.col("panel_info_id").alias("row_id"), "source", F.col("panel_caption").alias("text"))
    return truncation.judge(a.unionByName(b))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cut_captions(spark, sf_dir).where("p_cut > 0.5").select("table_name", "row_id")


def p1_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number and share of cut rows of every source, among its rows with a caption."""
    each = _cut_captions(spark, sf_dir).groupBy("table_name", "source")
    return each.agg(F.count("*").alias("n_rows"), F.sum((F.col("p_cut") > 0.5).cast("long")).alias("n_cut"), F.round(F.avg((F.col("p_cut") > 0.5).cast("double")), 6).alias("share_cut"))


def _caption_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "individual_caption").select(F.lit("figure_caption").alias("field_name"), F.col("caption_id").alias("id"), F.col("figure_caption").alias("text"))
    b = table(spark, sf_dir, "panel_list").select(F.lit("panel_caption").alias("field_name"), F.col("panel_id").alias("id"), F.col("panel_caption").alias("text"))
    return a.unionByName(b)


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.look_alike_pairs(_caption_texts(spark, sf_dir), "field_name", "id", "text")


def p3_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same without pairs: each text with its class and its number of links."""
    return normalize.look_alike_classes(_caption_texts(spark, sf_dir), "field_name", "id", "text")


def p3_normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _caption_texts(spark, sf_dir).select("field_name", "id", normalize.canonical_column(F.col("text")).alias("text"))


def _named(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry_match.match_names(table(spark, sf_dir, "data_source"), table(spark, sf_dir, "identifiers"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _named(spark, sf_dir).where("NOT exact").select("data_source_id", "registry_id")


def p4_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values that mean no entry, with the number of rows that have them."""
    return _named(spark, sf_dir).where("registry_id = 0").groupBy("database").agg(F.count("*").alias("n_rows"))


def p4_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values that are an entry's name as they stand."""
    return _named(spark, sf_dir).where("exact").select("data_source_id", "registry_id")


FIELDS = ["figure_legends", "data_availability"]


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = splitting.split_fields(table(spark, sf_dir, "extracted_sections"), table(spark, sf_dir, "size_limits"), "section_id", FIELDS, oversized_only=True)
    return cut.where("piece_no = 2").select("section_id", "field_name")


def p5_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splitting.split_fields(table(spark, sf_dir, "extracted_sections"), table(spark, sf_dir, "size_limits"), "section_id", FIELDS)


def p5_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each field: whether all its pieces are within the limit and share the overlap, and the
    digest of its bodies put together again. A row's pieces are as long as its text."""
    limits = table(spark, sf_dir, "size_limits").select(F.col("limit_name").alias("field_name"), "max_size", "overlap_size")
    got = p5_pieces(spark, sf_dir).join(F.broadcast(limits), "field_name")  # two rows at most
    body = F.expr("substring(piece, body_start - start + 1)")
    shared = (F.col("piece_no") == 1) | (F.col("body_start") - F.col("start") == F.least("body_start", "overlap_size"))
    each = got.groupBy("section_id", "field_name").agg(
        F.bool_and(F.char_length("piece") <= F.col("max_size")).alias("within"), F.bool_and(shared & (F.col("end") - F.col("start") == F.char_length("piece"))).alias("overlapping"),
        F.array_sort(F.collect_list(F.struct("piece_no", body.alias("body")))).alias("b"),
    )
    return each.select("section_id", "field_name", "within", "overlapping", F.md5(F.array_join("b.body", "")).alias("text_md5"))


def p6_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    limit = table(spark, sf_dir, "size_limits").where("limit_name = 'documents_text'").agg(F.min("max_size")).first()[0]
    return packing.pack_texts(table(spark, sf_dir, "documents"), "doc_id", "text", limit)


def p6_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Containers and the share of their space in use, over all documents."""
    limit = table(spark, sf_dir, "size_limits").where("limit_name = 'documents_text'").agg(F.min("max_size")).first()[0]
    each = p6_containers(spark, sf_dir).groupBy("container").agg(F.sum("n_tokens").alias("used"), F.count("*").alias("items"))
    return each.agg(F.count("*").alias("containers"), F.sum("items").alias("items"), F.sum("used").alias("tokens"), F.round(F.sum("used") / (F.count("*") * limit), 6).alias("share_used"))


def p6_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each document: how many parts it has, whether each is in one container and none of
    these over the capacity, and whether only an oversized document is divided."""
    limit = table(spark, sf_dir, "size_limits").where("limit_name = 'documents_text'").agg(F.min("max_size")).first()[0]
    parts = materialize(p6_containers(spark, sf_dir))
    fills = parts.groupBy("container").agg(F.sum("n_tokens").alias("used"), F.min("container_tokens").alias("lo"), F.max("container_tokens").alias("hi"))
    fits = fills.select("container", ((F.col("used") <= limit) & (F.col("lo") == F.col("used")) & (F.col("hi") == F.col("used"))).alias("fits"))
    each = parts.join(fits, "container").groupBy("doc_id").agg(F.count("*").alias("n"), F.countDistinct("part_no").alias("n_parts"), F.bool_and("fits").alias("fits"), F.sum("n_tokens").alias("tokens"))
    whole = (F.col("n") == F.greatest(F.lit(1), F.ceil(F.col("tokens") / limit))) & (F.col("n") == F.col("n_parts"))
    return each.select("doc_id", "fits", whole.alias("whole"))


def p6_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the containers are no more than 1 % over the least number that all tokens need, but for one."""
    limit = table(spark, sf_dir, "size_limits").where("limit_name = 'documents_text'").agg(F.min("max_size")).first()[0]
    return p6_usage(spark, sf_dir).select((F.col("containers") <= F.ceil(F.col("tokens") / (0.99 * limit)) + 1).alias("is_full"))


def _leaks(spark: SparkSession, sf_dir: str, masks: tuple[str, ...] = leakage.MASKS) -> DataFrame:
    return leakage.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"), masks=masks)


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _leaks(spark, sf_dir).where(F.col("longest_run") >= leakage.RUN).select("doc_id", "item_id")


def p7_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlaps of ten words and more, of which one word in five may be substituted."""
    return _leaks(spark, sf_dir, leakage.OVERLAP_MASKS).where(F.col("overlap_words") >= leakage.RUN)


def p7_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items that leaked, with the number of documents that hold them."""
    return p7_found(spark, sf_dir).groupBy("item_id").agg(F.count("*").alias("n_docs"))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spam.find_spam(table(spark, sf_dir, "documents")).where("stuffed_share > 0.5").select("doc_id")


def p8_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The share of each document's length that is stuffing."""
    return spam.find_spam(table(spark, sf_dir, "documents")).withColumn("stuffed_share", F.round("stuffed_share", 6))


QUERIES = {f.__name__: f for f in (p1_found, p1_sources, p3_found, p3_classes, p3_normalized, p4_found, p4_exact, p4_unmatched, p5_found, p5_pieces, p5_checks, p6_containers, p6_usage, p6_checks, p6_full, p7_found, p7_overlaps, p7_items, p8_found, p8_shares)}
ORACLES = {
    "p4_exact": "SELECT data_source_id, min(registry_id) AS registry_id FROM data_source JOIN identifiers ON database = name GROUP BY data_source_id",
    "p5_found": """
        SELECT section_id, 'figure_legends' AS field_name FROM extracted_sections
        WHERE length(figure_legends) > (SELECT max_size FROM size_limits WHERE limit_name = 'figure_legends')
        UNION ALL
        SELECT section_id, 'data_availability' FROM extracted_sections
        WHERE length(data_availability) > (SELECT max_size FROM size_limits WHERE limit_name = 'data_availability')
    """,
    "p5_checks": """
        SELECT section_id, 'figure_legends' AS field_name, true AS within, true AS overlapping, md5(figure_legends) AS text_md5 FROM extracted_sections WHERE figure_legends IS NOT NULL
        UNION ALL SELECT section_id, 'data_availability', true, true, md5(data_availability) FROM extracted_sections WHERE data_availability IS NOT NULL
    """,
    "p6_checks": "SELECT doc_id, true AS fits, true AS whole FROM documents",
    "p6_full": "SELECT count(*) > 0 AS is_full FROM documents",
    "p7_found": r"""
        WITH bare AS (SELECT 'd' AS side, doc_id AS id, regexp_replace(text, '</?[a-zA-Z][^<>]*>', ' ', 'g') AS t FROM documents UNION ALL SELECT 'i', item_id, regexp_replace(passage, '</?[a-zA-Z][^<>]*>', ' ', 'g') FROM eval_items),
        forms AS (SELECT side, id, t FROM bare UNION SELECT side, id, regexp_replace(t, '(\p{L})[-‐]\s*[\r\n]\s*(\p{L})', '\1\2', 'g') FROM bare),
        w AS (SELECT side, id, regexp_extract_all(lower(t), '[\p{L}\p{N}]+') AS w FROM forms),
        runs AS (SELECT DISTINCT side, id, array_to_string(w[k:k + 9], ' ') AS run FROM (SELECT side, id, w, unnest(range(1, len(w) - 8)) AS k FROM w WHERE len(w) >= 10))
        SELECT DISTINCT d.id AS doc_id, i.id AS item_id FROM runs d JOIN runs i ON d.run = i.run AND d.side = 'd' AND i.side = 'i'
    """,
}
ORACLES["p7_items"] = f"SELECT item_id, count(*) AS n_docs FROM ({ORACLES['p7_found']}) GROUP BY item_id"
