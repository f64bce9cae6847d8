"""Queries of the message, usage and check-metadata operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.functions import messages
from folioforge.operators import check_metadata
from folioforge.plans.catalog import query
from folioforge.sources.tables import table


@query("""SELECT caption_id, CASE WHEN caption_id % 2 = 0 THEN 'Second.' ELSE 'First.' END AS system, CASE WHEN caption_id % 2 = 0 THEN 'First.' || chr(10) || 'Second.' ELSE 'First.' END AS instructions,
    coalesce(figure_caption, '') AS asked, 'image/png' AS media_type, 'QUJD' AS data, 2 AS n_blocks, 2 AS n_turns, 'user,model' AS roles, 'input_text,input_image,input_image' AS kinds FROM individual_caption""")
def q79_message_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One conversation for each caption, with an image as data and one elsewhere, in three forms."""
    text = F.to_json(F.struct(F.coalesce("figure_caption", F.lit("")).alias("text"), F.lit("text").alias("type")))
    image = lambda url: F.lit(f'{{"type": "image_url", "image_url": {{"url": "{url}"}}}}')
    second = F.when(F.col("caption_id") % 2 == 0, F.lit('{"role": "system", "content": "Second."}, ')).otherwise("")
    chat = F.concat(F.lit('[{"role": "system", "content": "First."}, '), second, F.lit('{"role": "user", "content": ['), text, F.lit(", "), image("data:image/png;base64,QUJD"), F.lit(", "), image("https://x.example/y.png"), F.lit(', 3]}, {"role": "assistant", "content": "Done."}]'))
    m = messages.parse(F.col("chat"))
    rows = table(spark, sf_dir, "individual_caption").select("caption_id", chat.alias("chat")).select("caption_id", messages.with_image_blocks(m).alias("a"), messages.with_typed_input(m).alias("b"), messages.with_inline_data(m).alias("c"))
    first = F.col("a.messages")[0]["content"]
    return rows.select(
        "caption_id", F.col("a.system").alias("system"), F.col("b.instructions").alias("instructions"), first[0]["text"].alias("asked"), first[1]["source"]["media_type"].alias("media_type"), F.col("c.contents")[0]["parts"][1]["inline_data"]["data"].alias("data"),
        F.size(first).alias("n_blocks"), F.size("b.input").alias("n_turns"), F.array_join("c.contents.role", ",").alias("roles"), F.array_join(F.col("b.input")[0]["content"]["type"], ",").alias("kinds"),
    )


@query("""SELECT event_id, CASE WHEN event_id % 3 = 2 THEN 0 ELSE event_id % 100 END AS prompt_tokens, CASE WHEN event_id % 3 = 2 THEN 0 ELSE 7 END AS completion_tokens, CASE WHEN event_id % 3 = 0 THEN 500 WHEN event_id % 3 = 1 THEN event_id % 100 + 7 ELSE 0 END AS total_tokens,
    CASE WHEN event_id % 2 = 0 THEN 'whole' ELSE 'a' || chr(10) || 'b' END AS answer, CASE WHEN event_type IS NULL THEN '' ELSE 'k=' || json_extract_string(props, '$.k') || ',t=' || event_type END AS metadata,
    ['o200k_base', 'o200k_base', 'cl100k_base', 'cl100k_base'][event_id % 4 + 1] AS encoding FROM events""")
def q80_usage_and_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, none = F.col("event_id"), F.lit(None).cast("bigint")
    m = k % 3
    used = messages.usage(F.when(m == 0, k % 100), F.when(m == 0, F.lit(7)), F.when(m == 0, F.lit(500)), F.when(m == 1, k % 100), F.when(m == 1, F.lit(7)).otherwise(none))
    text = messages.answer_text(F.when(k % 2 == 0, "whole").otherwise(""), F.array(F.lit("a"), F.lit(""), F.lit("b ")))
    metadata = F.concat(F.lit('{"t": "'), F.col("event_type"), F.lit('", "z": null, "k": '), F.get_json_object("props", "$.k"), F.lit("}"))
    shown = F.array_join(F.transform(F.array_sort(F.map_entries(messages.text_metadata(metadata))), lambda e: F.concat_ws("=", e["key"], e["value"])), ",")
    model = F.element_at(F.array(*[F.lit(x) for x in ("gpt-4o-mini", "o1", "gpt-4o2", "gpt-4")]), (k % 4 + 1).cast("int"))
    rows = table(spark, sf_dir, "events")
    return rows.select("event_id", used.alias("u"), text.alias("answer"), shown.alias("metadata"), messages.encoding_of(model).alias("encoding")).select("event_id", "u.*", "answer", "metadata", "encoding")


@query("""SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 2 ELSE 0 END AS n_tools, CASE WHEN p_partkey % 5 = 0 THEN CASE WHEN p_partkey % 3 = 0 THEN 'auto' ELSE 'tool:answer' END WHEN p_partkey % 5 = 1 THEN 'auto' WHEN p_partkey % 5 = 2 THEN 'tool:answer' WHEN p_partkey % 5 = 3 THEN 'tool:' || p_brand ELSE 'tool:answer' END AS choice FROM part""")
def q81_tools(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tools a provider runs by itself, and how one is chosen."""
    k = F.col("p_partkey")
    tool = lambda t: F.struct(F.lit(t).alias("type"))
    kept = messages.built_in_tools(F.when(k % 3 == 0, F.array(tool("web_search_2"), tool(" web_fetch"), tool("own"), tool(None))).otherwise(F.array(tool("own"))))
    word = F.when(k % 5 == 1, " Any").when(k % 5 == 2, "off").when(k % 5 == 3, "tool").when(k % 5 == 4, "tool")
    choice = messages.tool_choice(word, F.when(k % 5 == 3, F.col("p_brand")), F.size(kept) > 0, "answer")
    return table(spark, sf_dir, "part").select("p_partkey", F.size(kept).alias("n_tools"), choice.alias("c")).select("p_partkey", "n_tools", F.concat_ws(":", "c.type", "c.name").alias("choice"))


@query("""WITH c AS (SELECT 'check_' || lower(replace(name, ' ', '_')) AS check_name, CASE WHEN registry_id % 3 = 0 THEN name END AS name, 'local' AS description, CASE WHEN registry_id % 4 = 0 THEN 'doc-checklist' END AS lt, CASE WHEN registry_id % 5 = 0 THEN 'own/' || registry_id END AS pn, registry_id AS k FROM identifiers),
    t AS (SELECT *, coalesce(lt, CASE WHEN k % 2 = 0 AND k % 6 = 2 THEN 'remote-checklist' END, 'fig-checklist') AS l FROM c), p AS (SELECT *, coalesce(pn, 'checklists/' || l || '/' || replace(check_name, '_', '-')) AS full_name FROM t)
    SELECT check_name, l AS checklist_type, full_name AS prompt_name, CASE WHEN k % 2 = 0 THEN CASE WHEN k % 6 = 0 THEN 'Plain.' WHEN k % 6 = 2 THEN 'Sys.' ELSE 'Ask.' || chr(10) || 'Answer.' END END AS system_text, CASE WHEN k % 2 = 0 AND k % 6 <> 0 THEN 'Ask.' END AS user_text,
        CASE WHEN k % 2 = 0 AND k % 6 = 2 THEN '{"a":1}' WHEN k % 2 = 0 AND k % 6 = 4 THEN '{"b":2}' END AS schema, coalesce(name, array_to_string([upper(w[1]) || w[2:] for w in string_split(replace(check_name, '_', ' '), ' ')], ' ')) AS name,
        CASE WHEN k % 2 = 0 AND k % 6 = 4 THEN 'remote' ELSE 'local' END AS description, CASE WHEN k % 2 = 0 THEN 'https://p.example/prompts/' || full_name ELSE '' END AS permalink, CASE WHEN k % 2 = 0 THEN '3' ELSE 'latest' END AS version,
        CASE WHEN k % 2 = 1 THEN 'no prompt' WHEN k % 6 = 0 THEN 'no schema' END AS problem FROM p""")
def q82_check_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry entries as checks, every second with a remote prompt of one of three makes."""
    k = F.col("registry_id")
    rows = table(spark, sf_dir, "identifiers").select(F.concat(F.lit("check_"), F.lower(F.replace("name", F.lit(" "), F.lit("_")))).alias("check_name"), "name", "registry_id")
    checks = rows.select("check_name", F.when(k % 3 == 0, F.col("name")).alias("name"), F.lit("local").alias("description"), F.when(k % 4 == 0, "doc-checklist").alias("checklist_type"), F.when(k % 5 == 0, F.concat(F.lit("own/"), k)).alias("prompt_name"))
    prompt = F.when(k % 6 == 0, "Plain.").when(k % 6 == 2, '[{"role": "system", "content": "Sys."}, {"role": "user", "content": "Ask."}]').otherwise('[{"role": "user", "content": "Ask."}, {"role": "assistant", "content": "Answer."}]')
    config = F.when(k % 6 == 0, "{}").when(k % 6 == 2, '{"checklist_type": "remote-checklist", "schema": {"a":1}}').otherwise('{"description": "remote", "output_schema": {"format": {"schema": {"b":2}}}}')
    prompts = rows.where("registry_id % 2 = 0").select("check_name", prompt.alias("prompt"), config.alias("config"), F.lit(3).alias("version"))
    return check_metadata.describe_checks(checks, prompts, "https://p.example")
