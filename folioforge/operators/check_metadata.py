"""What is known of checks: local settings joined with the remote prompts, where there are any."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Where a check belongs if nobody says, and what its version is without a prompt.
DEFAULT_LIST, DEFAULT_VERSION = "fig-checklist", "latest"
CHAT = "array<struct<role:string,content:string>>"


def prompt_name(check: Column, override: Column, checklist: Column) -> Column:
    """The full name of a check's prompt: its own, or by list and check with hyphens."""
    return F.coalesce(F.nullif(override, F.lit("")), F.concat(F.lit("checklists/"), checklist, F.lit("/"), F.replace(check, F.lit("_"), F.lit("-"))))


def _role(chat: Column, role: str) -> Column:
    return F.get(F.filter(chat, lambda m: m["role"] == role), F.lit(0))["content"]


def describe_checks(checks: DataFrame, prompts: DataFrame, base_url: str) -> DataFrame:
    """One row for each check with its list, prompt texts, schema, name, description, permalink and
    version.

    checks: (check_name, name, description, checklist_type, prompt_name), nulls for what is not
    set; prompts: (check_name, prompt, config, version) with the prompt as text or as a JSON
    list of messages and the config as JSON, one row a check at most. Local settings win, but
    for the description. A check without a prompt has its local settings and no schema;
    problem says what is missing.
    """
    got = checks.join(prompts.select("check_name", "prompt", "config", F.col("version").cast("string").alias("version")), "check_name", "left")
    remote = lambda path: F.get_json_object("config", f"$.{path}")
    checklist = F.coalesce("checklist_type", remote("checklist_type"), F.lit(DEFAULT_LIST))
    chat = F.when(F.col("prompt").startswith("["), F.from_json("prompt", CHAT))
    schema = F.coalesce(remote("schema"), remote("output_schema.format.schema"), remote("output_schema"))
    title = F.initcap(F.replace("check_name", F.lit("_"), F.lit(" ")))
    known = F.col("version").isNotNull()
    return got.select(
        "check_name", checklist.alias("checklist_type"), prompt_name(F.col("check_name"), F.col("prompt_name"), checklist).alias("prompt_name"),
        F.coalesce(_role(chat, "system"), F.array_join(F.transform(chat, lambda m: F.coalesce(m["content"], F.lit(""))), "\n"), "prompt").alias("system_text"), _role(chat, "user").alias("user_text"), schema.alias("schema"),
        F.coalesce(F.nullif("name", F.lit("")), remote("name"), title).alias("name"), F.coalesce(remote("description"), "description", F.lit("")).alias("description"),
        F.when(known, F.concat(F.lit(f"{base_url}/prompts/"), prompt_name(F.col("check_name"), F.col("prompt_name"), checklist))).otherwise("").alias("permalink"),
        F.coalesce("version", F.lit(DEFAULT_VERSION)).alias("version"), F.when(~known, "no prompt").when(schema.isNull(), "no schema").alias("problem"),
    )


def passed(level: Column, result: Column) -> Column:
    """Whether a check passed by its result alone: of a figure if the result is there and not
    empty, of the document if there is any, even an empty object."""
    bare = F.regexp_replace(F.coalesce(result, F.lit("")), r"\s", "")
    return F.when(level == "document", result.isNotNull()).otherwise(~bare.isin("", "{}", "[]", "null", "false"))
