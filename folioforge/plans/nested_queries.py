"""Queries of the nested-record operator."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.operators import nested
from folioforge.session import materialize
from folioforge.sources.tables import table


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "manuscript_records")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested.bridge(_records(spark, sf_dir), only=nested.CHILDREN).select("record_id", "child", "figure_no", "panel_no", "item_no")


def p2_bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested.bridge(_records(spark, sf_dir))


def p2_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested.store(nested.decompose(_records(spark, sf_dir)))


def p2_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Broken links between bridge and store, either way, and parents that have no row: none."""
    parts = materialize(nested.decompose(_records(spark, sf_dir)))
    nodes, objects = parts.select("node_id").distinct(), nested.store(parts).select("node_id")
    parents = parts.where("parent_id IS NOT NULL").select("record_id", F.col("parent_id").alias("node_id")).distinct()
    checks = {"nodes_without_object": nodes.join(objects, "node_id", "left_anti"), "objects_without_node": objects.join(nodes, "node_id", "left_anti"), "parents_without_row": parents.join(parts.select("record_id", "node_id").distinct(), ["record_id", "node_id"], "left_anti")}
    rows = [lost.select(F.lit(name).alias("link")) for name, lost in checks.items()]
    names = spark.createDataFrame([(n,) for n in checks], "link string")
    return names.join(reduce(DataFrame.unionByName, rows).groupBy("link").agg(F.count("*").alias("n")), "link", "left").select("link", F.coalesce("n", F.lit(0)).cast("bigint").alias("n_broken"))


def p2_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = nested.flat(_records(spark, sf_dir), "figure")
    return rows.select("record_id", "figure_no", *map(_named, ("figure_label", "caption_title", "figure_caption")))


def p2_panels(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = nested.flat(_records(spark, sf_dir), "panel")
    numbers = [nested.number_of(nested.text_field(n)).alias(n) for n in ("confidence", "hallucination_score")]
    return rows.select("record_id", "figure_no", "panel_no", *map(_named, ("panel_label", "panel_caption")), *numbers)


def p2_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested.flat(_records(spark, sf_dir), "panel_bbox").select("record_id", "figure_no", "panel_no", *nested.coordinates())


def p2_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = nested.flat(_records(spark, sf_dir), "figure_file", "panel_file")
    file = F.get_json_object(F.concat(F.lit('{"f":'), F.col("body"), F.lit("}")), "$.f")
    return rows.select("record_id", "child", "figure_no", "panel_no", "item_no", file.alias("file"))


def _named(name: str) -> Column:
    return nested.text_field(name).alias(name)


def _each(source: str, value: str, keys: str, number: str) -> str:
    """SQL: the children in a JSON value, an array or a single child, with their positions."""
    listed = f"CASE json_type({value}) WHEN 'ARRAY' THEN from_json({value}, '[\"JSON\"]') WHEN 'NULL' THEN [] ELSE [{value}] END"
    return f"SELECT {keys}, unnest(l) AS x, generate_subscripts(l, 1) AS {number} FROM (SELECT {keys}, {listed} AS l FROM {source} WHERE {value} IS NOT NULL)"


_TEXT_BOX = r"^\s*[\[(]?\s*-?[0-9.eE+-]+\s*,\s*-?[0-9.eE+-]+\s*,\s*-?[0-9.eE+-]+\s*,\s*-?[0-9.eE+-]+\s*[\])]?\s*$"
_NUMBERS = "json_type({0}) IN ('DOUBLE', 'UBIGINT', 'BIGINT')"

_CHILDREN = f"""
    d AS (SELECT record_id, payload::JSON AS j FROM manuscript_records WHERE json_valid(payload)),
    m AS (SELECT record_id, CASE WHEN json_exists(j, '$.figures') THEN j->'figures' WHEN json_exists(j, '$.manuscript.figures') THEN j->'manuscript'->'figures' ELSE j->'result'->'structure'->'figures' END AS f FROM d),
    f AS (SELECT record_id, figure_no::INTEGER AS figure_no, x AS f FROM ({_each("m", "f", "record_id", "figure_no")}) WHERE json_type(x) = 'OBJECT'),
    p AS (SELECT record_id, figure_no, panel_no::INTEGER AS panel_no, x AS p FROM ({_each("(SELECT record_id, figure_no, f->'panels' AS v FROM f)", "v", "record_id, figure_no", "panel_no")}) WHERE json_type(x) = 'OBJECT'),
    ff AS (SELECT record_id, figure_no, item_no::INTEGER AS item_no, x->>'$' AS file FROM ({_each("(SELECT record_id, figure_no, f->'sd_files' AS v FROM f)", "v", "record_id, figure_no", "item_no")}) WHERE json_type(x) = 'VARCHAR' AND trim(x->>'$') <> ''),
    pf AS (SELECT record_id, figure_no, panel_no, item_no::INTEGER AS item_no, x->>'$' AS file FROM ({_each("(SELECT record_id, figure_no, panel_no, p->'sd_files' AS v FROM p)", "v", "record_id, figure_no, panel_no", "item_no")}) WHERE json_type(x) = 'VARCHAR' AND trim(x->>'$') <> ''),
    b AS (SELECT record_id, figure_no, panel_no, b, CASE json_type(b) WHEN 'ARRAY' THEN [b->>0, b->>1, b->>2, b->>3] WHEN 'OBJECT' THEN [{", ".join(f"b->>'{k}'" for k in nested.COORDINATES)}] ELSE string_split(regexp_replace(b->>'$', '[\\[\\]() ]', '', 'g'), ',') END AS xy
        FROM (SELECT record_id, figure_no, panel_no, p->'panel_bbox' AS b FROM p) WHERE
        (json_type(b) = 'ARRAY' AND json_array_length(b) = 4 AND {" AND ".join(_NUMBERS.format(f"b->{i}") for i in range(4))})
        OR (json_type(b) = 'OBJECT' AND {" AND ".join(_NUMBERS.format(f"b->'{k}'") for k in nested.COORDINATES)})
        OR (json_type(b) = 'VARCHAR' AND regexp_matches(b->>'$', '{_TEXT_BOX}')))
"""

ORACLES = {
    "p2_found": f"""WITH {_CHILDREN}
    SELECT record_id, 'figure' AS child, figure_no, 0 AS panel_no, 0 AS item_no FROM f
    UNION ALL SELECT record_id, 'figure_file', figure_no, 0, item_no FROM ff
    UNION ALL SELECT record_id, 'panel', figure_no, panel_no, 0 FROM p
    UNION ALL SELECT record_id, 'panel_file', figure_no, panel_no, item_no FROM pf
    UNION ALL SELECT record_id, 'panel_bbox', figure_no, panel_no, 0 FROM b""",
    "p2_figures": f"WITH {_CHILDREN} SELECT record_id, figure_no, f->>'figure_label' AS figure_label, f->>'caption_title' AS caption_title, f->>'figure_caption' AS figure_caption FROM f",
    "p2_panels": f"WITH {_CHILDREN} SELECT record_id, figure_no, panel_no, p->>'panel_label' AS panel_label, p->>'panel_caption' AS panel_caption, try_cast(p->>'confidence' AS DOUBLE) AS confidence, try_cast(p->>'hallucination_score' AS DOUBLE) AS hallucination_score FROM p",
    "p2_boxes": f"WITH {_CHILDREN} SELECT record_id, figure_no, panel_no, " + ", ".join(f"xy[{k}]::DOUBLE AS {c}" for k, c in enumerate(nested.COORDINATES, 1)) + " FROM b",
    "p2_files": f"WITH {_CHILDREN} SELECT record_id, 'figure_file' AS child, figure_no, 0 AS panel_no, item_no, file FROM ff UNION ALL SELECT record_id, 'panel_file', figure_no, panel_no, item_no, file FROM pf",
    "p2_links": "SELECT unnest(['nodes_without_object', 'objects_without_node', 'parents_without_row']) AS link, 0::BIGINT AS n_broken",
}

QUERIES = {f.__name__: f for f in (p2_found, p2_bridge, p2_objects, p2_links, p2_figures, p2_panels, p2_boxes, p2_files)}
