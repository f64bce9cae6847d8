"""Chat messages, tools, usage and answers between the forms that model providers use."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PART = "struct<type:string,text:string,url:string>"
MESSAGE = f"struct<role:string,text:string,parts:array<{PART}>>"
# Tools that a provider runs by itself, by the beginning of their type.
BUILT_IN_TOOLS = ("web_search", "web_fetch")
# Families of models that share the newer token encoding; and both encodings.
NEWER_FAMILIES = ("gpt-5", "gpt-4o", "gpt-4.1", "gpt-4.5", "o1", "o3", "o4-mini")
NEWER_ENCODING, OLDER_ENCODING = "o200k_base", "cl100k_base"


def parse(messages: Column) -> Column:
    """array of messages from JSON: role (user if there is none), and either a text or parts; null
    for no JSON array. Parts that are no objects are left out."""
    raw = F.from_json(messages, "array<struct<role:string,content:variant>>")
    part = lambda p: F.struct(
        F.try_variant_get(p, "$.type", "string").alias("type"), F.try_variant_get(p, "$.text", "string").alias("text"), F.try_variant_get(p, "$.image_url.url", "string").alias("url")
    )
    listed = lambda c: F.filter(F.transform(F.try_variant_get(c, "$", "array<variant>"), part), lambda p: p["type"].isNotNull())
    is_list = lambda c: F.schema_of_variant(c).startswith("ARRAY")
    return F.transform(raw, lambda m: F.struct(
        F.coalesce(m["role"], F.lit("user")).alias("role"), F.when(~is_list(m["content"]), F.try_variant_get(m["content"], "$", "string")).alias("text"), F.when(is_list(m["content"]), listed(m["content"])).alias("parts"),
    ))


def _system(messages: Column) -> Column:
    return F.transform(F.filter(messages, lambda m: (m["role"] == "system") & m["text"].isNotNull()), lambda m: m["text"])


def _data(url: Column) -> Column:
    """struct(media_type, data) of a data URL, whatever its encoding is called."""
    head = F.regexp_extract(url, r"^data:([^;,]*)", 1)
    return F.when(url.startswith("data:") & url.contains(","), F.struct(head.alias("media_type"), F.regexp_extract(url, r"(?s)^[^,]*,(.*)$", 1).alias("data")))


def with_image_blocks(messages: Column) -> Column:
    """struct(system, messages): the last system text apart; of users and assistants the text, or
    blocks of texts and of images given as data. Images elsewhere are left out."""
    block = lambda p: F.struct(p["type"].alias("type"), F.when(p["type"] == "text", p["text"]).alias("text"), F.when(p["type"] == "image_url", _data(p["url"])).alias("source"))
    kept = lambda parts: F.filter(F.transform(parts, block), lambda b: (b["type"] == "text") | b["source"].isNotNull())
    named = lambda b: F.struct(F.when(b["type"] == "text", "text").otherwise("image").alias("type"), b["text"].alias("text"), b["source"].alias("source"))
    turns = F.filter(messages, lambda m: m["role"].isin("user", "assistant"))
    return F.struct(
        F.coalesce(F.try_element_at(_system(messages), F.lit(-1)), F.lit("")).alias("system"),
        F.transform(turns, lambda m: F.struct(m["role"].alias("role"), m["text"].alias("text"), F.transform(kept(m["parts"]), named).alias("content"))).alias("messages"),
    )


def _turns(messages: Column) -> Column:
    """Messages but the system's, a text as a single part; those without a part left out."""
    one = lambda m: F.array(F.struct(F.lit("text").alias("type"), m["text"].alias("text"), F.lit(None).cast("string").alias("url")))
    whole = F.transform(F.filter(messages, lambda m: m["role"] != "system"), lambda m: F.struct(m["role"].alias("role"), F.coalesce(m["parts"], F.when(m["text"].isNotNull(), one(m))).alias("parts")))
    used = lambda p: (p["type"] == "text") | ((p["type"] == "image_url") & (F.coalesce(p["url"], F.lit("")) != ""))
    trimmed = F.transform(whole, lambda m: F.struct(m["role"].alias("role"), F.filter(m["parts"], used).alias("parts")))
    return F.filter(trimmed, lambda m: F.coalesce(F.size(m["parts"]) > 0, F.lit(False)))


def with_typed_input(messages: Column) -> Column:
    """struct(instructions, input): all system texts by lines; turns of input_text and input_image."""
    part = lambda p: F.struct(F.when(p["type"] == "text", "input_text").otherwise("input_image").alias("type"), F.when(p["type"] == "text", F.coalesce(p["text"], F.lit(""))).alias("text"), F.when(p["type"] == "image_url", p["url"]).alias("image_url"))
    turns = F.transform(_turns(messages), lambda m: F.struct(m["role"].alias("role"), F.transform(m["parts"], part).alias("content")))
    return F.struct(F.array_join(_system(messages), "\n").alias("instructions"), turns.alias("input"))


def with_inline_data(messages: Column) -> Column:
    """struct(instructions, contents): turns of user and model, images as inline data; images that
    are no data are left out, and so are turns without a part."""
    part = lambda p: F.struct(F.when(p["type"] == "text", F.coalesce(p["text"], F.lit(""))).alias("text"), F.when(p["type"] == "image_url", _data(p["url"])).alias("inline_data"))
    turns = F.transform(_turns(messages), lambda m: F.struct(
        F.when(m["role"] == "assistant", "model").otherwise("user").alias("role"),
        F.filter(F.transform(m["parts"], part), lambda p: p["text"].isNotNull() | p["inline_data"].isNotNull()).alias("parts"),
    ))
    return F.struct(F.array_join(_system(messages), "\n").alias("instructions"), F.filter(turns, lambda m: F.size(m["parts"]) > 0).alias("contents"))


def built_in_tools(tools: Column) -> Column:
    """Of an array of structs with a type, the tools that the provider runs by itself."""
    kept = lambda t: F.exists(F.array(*[F.lit(p) for p in BUILT_IN_TOOLS]), lambda p: F.startswith(F.trim(t["type"]), p))
    return F.coalesce(F.filter(tools, lambda t: F.coalesce(kept(t), F.lit(False))), F.filter(tools, lambda t: F.lit(False)))


def tool_choice(choice: Column, name: Column, has_tools: Column, structured: str) -> Column:
    """struct(type, name) of how a tool is chosen, from a word, or a type with a name: auto and any
    leave it to the model, tool with a name sets that one; all else, and no choice without
    tools, sets the tool of the structured output."""
    word = F.lower(F.trim(choice))
    auto, fixed = F.struct(F.lit("auto").alias("type"), F.lit(None).cast("string").alias("name")), F.struct(F.lit("tool").alias("type"), F.lit(structured).alias("name"))
    own = F.struct(F.lit("tool").alias("type"), name.alias("name"))
    return F.when(choice.isNull(), F.when(has_tools, auto).otherwise(fixed)).when(word.isin("auto", "any"), auto).when((word == "tool") & (F.coalesce(name, F.lit("")) != ""), own).otherwise(fixed)


def usage(prompt: Column, completion: Column, total: Column, input_: Column, output: Column) -> Column:
    """struct(prompt_tokens, completion_tokens, total_tokens) from whichever names are given; 0 for
    none, the total summed where it is not stated."""
    p, c = F.coalesce(prompt, input_, F.lit(0)).cast("bigint"), F.coalesce(completion, output, F.lit(0)).cast("bigint")
    return F.struct(p.alias("prompt_tokens"), c.alias("completion_tokens"), F.coalesce(total.cast("bigint"), p + c).alias("total_tokens"))


def answer_text(whole: Column, chunks: Column) -> Column:
    """The text of an answer if it has one, else its chunks that are not empty, by lines, trimmed."""
    joined = F.trim(F.array_join(F.filter(chunks, lambda c: c != ""), "\n"))
    return F.coalesce(F.nullif(whole, F.lit("")), joined, F.lit(""))


def text_metadata(metadata: Column) -> Column:
    """A JSON object as a map of texts: texts as they are, all else as JSON, nulls left out."""
    values = F.from_json(metadata, "map<string,variant>")
    shown = F.transform_values(values, lambda k, v: F.when(F.schema_of_variant(v) == "STRING", F.try_variant_get(v, "$", "string")).when(~F.is_variant_null(v), F.to_json(v)))
    return F.map_filter(shown, lambda k, v: v.isNotNull())


def encoding_of(model: Column) -> Column:
    """The token encoding of a model by its family."""
    newer = F.exists(F.array(*[F.lit(f) for f in NEWER_FAMILIES]), lambda f: (model == f) | model.startswith(F.concat(f, F.lit("-"))))
    return F.when(newer, NEWER_ENCODING).otherwise(OLDER_ENCODING)
