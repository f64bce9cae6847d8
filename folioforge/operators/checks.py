"""Quality checks as data: fan-out over subjects, keyword rules, results by subject, issues."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.operators.linkage import small


def fan_out(subjects: DataFrame, checks: DataFrame, level: str = "level", whole: str = "document", is_first: str = "is_first") -> DataFrame:
    """Each subject with each check of its level; checks of the whole only with the subject
    marked first. An equi-join on the level, so a check list is never crossed with a table."""
    at = subjects.withColumn(level, F.explode(F.when(F.col(is_first), F.array(F.lit("panel"), F.lit("figure"), F.lit(whole))).otherwise(F.array(F.lit("panel"), F.lit("figure")))))
    return at.join(small(checks), level)


def keyword_rules(text: Column, rules: dict[str, tuple[str, ...]]) -> Column:
    """An array of the names of all rules of which some keyword stands in the text, any case."""
    low = F.lower(text)
    hits = [F.when(reduce(lambda a, b: a | b, (low.contains(k.lower()) for k in words)), F.lit(name)) for name, words in rules.items()]
    return F.array_compact(F.array(*hits))


def wrap_outputs(reply: Column, schema: str) -> Column:
    """The outputs array of a reply: as it stands, or of the bare object; empty for no JSON."""
    listed = F.from_json(reply, f"outputs array<{schema}>")["outputs"]
    bare = F.from_json(reply, schema)
    return F.coalesce(listed, F.when(F.try_parse_json(reply).isNotNull() & reply.rlike(r"^\s*\{"), F.array(bare)), F.array().cast(f"array<{schema}>"))


def required_fields(doc: Column, names: list[str]) -> Column:
    """Names that a JSON object lacks or has as null; all of them for what is no JSON."""
    return F.array_compact(F.array(*[F.when(F.get_json_object(doc, f"$.{n}").isNull(), F.lit(n)) for n in names]))


def results_by_subject(results: DataFrame, subject: str, part: str, check: str, passed: str) -> DataFrame:
    """(subject, part, n_checks, n_passed, failed): failed names sorted; parts without a label
    go under unknown. Check names of a part are a set, as long as the check list at most."""
    label = F.coalesce(F.nullif(F.trim(part), F.lit("")), F.lit("unknown"))
    got = results.groupBy(subject, label.alias(part)).agg(F.count("*").alias("n_checks"), F.sum(F.col(passed).cast("bigint")).alias("n_passed"), F.sort_array(F.collect_set(F.when(~F.col(passed), F.col(check)))).alias("failed"))
    return got.withColumn("failed", F.array_join("failed", ","))


def to_pixels(box: list[Column], width: Column, height: Column) -> list[Column]:
    """Relative corners as whole pixels."""
    return [F.floor(c * side).cast("int") for c, side in zip(box, (width, height, width, height))]


def fit_size(width: Column, height: Column, longest: int = 2048, most_pixels: int = 178_956_970) -> tuple[Column, Column]:
    """Width and height scaled down to a pixel count, then to a longest side; never up."""
    by_count = F.least(F.lit(1.0), F.sqrt(F.lit(float(most_pixels)) / (width * height)))
    w, h = F.floor(width * by_count), F.floor(height * by_count)
    by_side = F.least(F.lit(1.0), F.lit(float(longest)) / F.greatest(w, h))
    return F.floor(w * by_side).cast("int"), F.floor(h * by_side).cast("int")
