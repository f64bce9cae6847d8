"""Model replies read into typed values, with the default for what can't be read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.functions.text import json_in_reply

SECTIONS = "figure_legends string, data_availability string"
SOURCES = "array<struct<database:string,accession_number:string,url:string>>"
FILES = "assigned_files array<struct<panel_label:string,panel_sd_files:array<string>>>, not_assigned_files array<string>"


def _json(reply: Column, opening: str, closing: str) -> Column:
    """The JSON text of a reply, or the reply itself, if it is an object (or array); else null."""
    s = F.regexp_replace(F.coalesce(json_in_reply(reply, opening, closing), reply), r"\s+", " ")
    return F.when(F.try_parse_json(s).isNotNull() & F.ltrim(s).startswith(opening), s)


def typed(reply: Column, schema: str) -> Column:
    """struct of a schema from the object of a reply; its fields null for what is not there."""
    return F.coalesce(F.from_json(_json(reply, "{", "}"), schema), F.from_json(F.lit("{}"), schema))


def listed(reply: Column, schema: str) -> Column:
    """An array of a schema from the array of a reply; empty for none."""
    return F.coalesce(F.from_json(_json(reply, "[", "]"), schema), F.array().cast(schema))


def sections(reply: Column) -> Column:
    """struct of both sections; empty texts for a reply without a JSON object."""
    got = F.from_json(_json(reply, "{", "}"), SECTIONS)
    empty = F.struct(*[F.lit("").alias(c) for c in ("figure_legends", "data_availability")])
    return F.coalesce(got, empty)


def sources(reply: Column) -> Column:
    """The array of data sources; empty for a reply without a JSON array."""
    return listed(reply, SOURCES)


def files(reply: Column) -> Column:
    """struct of the files given to panels and of those left over; empty arrays for no JSON object."""
    got = F.from_json(_json(reply, "{", "}"), FILES)
    given, left = "array<struct<panel_label:string,panel_sd_files:array<string>>>", "array<string>"
    return F.struct(F.coalesce(got["assigned_files"], F.array().cast(given)).alias("assigned_files"), F.coalesce(got["not_assigned_files"], F.array().cast(left)).alias("not_assigned_files"))


def merge_files(chunks: DataFrame, request: str, order: str, reply: str, usage: tuple[str, ...] = ("prompt_tokens", "completion_tokens", "total_tokens")) -> DataFrame:
    """(request, assigned_files, not_assigned_files, usage...): the replies to the chunks of a request
    as one, lists joined in the order of the chunks, usage summed. Chunks without a readable
    reply add nothing but their usage. A request's replies are one model answer taken apart,
    so joined again they are no larger than that answer."""
    read = chunks.select(request, F.col(order).alias("__o"), files(F.col(reply)).alias("f"), *usage)
    got = read.groupBy(request).agg(F.array_sort(F.collect_list(F.struct("__o", "f"))).alias("r"), *[F.sum(u).alias(u) for u in usage])
    return got.select(request, F.flatten("r.f.assigned_files").alias("assigned_files"), F.flatten("r.f.not_assigned_files").alias("not_assigned_files"), *usage)
