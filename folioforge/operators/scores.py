"""Scores of whole outputs against what was expected."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.functions.similarity import jaccard
from folioforge.operators.linkage import meet


def file_score(expected: Column, actual: Column) -> Column:
    """Expected files that are there over the number expected; 1 for two empty lists, 0 for one.
    A null list counts as empty."""
    n = lambda c: F.coalesce(F.size(c), F.lit(0))
    hit = F.size(F.array_intersect(expected, actual)) / F.greatest(n(expected), F.lit(1))
    return F.when((n(expected) <= 0) & (n(actual) <= 0), 1.0).when((n(expected) <= 0) | (n(actual) <= 0), 0.0).otherwise(hit)


def panel_scores(expected: DataFrame, actual: DataFrame, found_figures_only: bool = False) -> DataFrame:
    """(figure, panel, score): every expected panel's files against those of the actual panel.

    Both sides are (figure, panel, files), panels unique. A panel that is missing has no files;
    with found_figures_only, panels of figures without any actual row are left out.
    """
    got = actual.select("figure", "panel", F.col("files").alias("actual"))
    rows = expected.join(actual.select("figure").distinct(), "figure", "left_semi") if found_figures_only else expected
    return rows.join(got, ["figure", "panel"], "left").select("figure", "panel", file_score(F.col("files"), F.col("actual")).alias("score"))


def source_scores(expected: DataFrame, actual: DataFrame, key: str) -> DataFrame:
    """(key, exact, likeness, score): for each key with expected sources, the share of them that is
    there exactly, the mean likeness of the best actual one, and the mean of both.

    Sources are (key, database, accession_number), compared in lower case without outer blanks,
    nulls as empty; likeness is the mean Jaccard index of the words of both fields. A key with
    actual sources only scores 0. Only distinct sources of a key meet, hot keys dealt out.
    """
    def clean(df: DataFrame) -> DataFrame:
        return df.select(key, *[F.lower(F.trim(F.coalesce(c, F.lit("")))).alias(c) for c in ("database", "accession_number")])

    fields = ["database", "accession_number"]
    e = clean(expected).groupBy(key, *fields).agg(F.count("*").alias("n")).withColumn("of_e", F.concat_ws("\x1f", *fields))
    a = clean(actual).distinct().select(key, *[F.col(c).alias(f"__{c}") for c in fields]).withColumn("of_a", F.concat_ws("\x1f", *[f"__{c}" for c in fields]))
    words = lambda c: F.array_distinct(F.filter(F.split(c, r"\s+"), lambda w: w != ""))
    alike = (jaccard(words("database"), words("__database")) + jaccard(words("accession_number"), words("__accession_number"))) / 2
    best = meet(e, a, key, "of_e", "of_a").groupBy(key, "of_e").agg(F.max(alike).alias("likeness"), F.bool_or(F.col("of_e") == F.col("of_a")).alias("exact"))
    each = e.join(best, [key, "of_e"], "left")
    total = F.sum("n")
    got = each.groupBy(key).agg((F.sum(F.when(F.col("exact"), F.col("n")).otherwise(0)) / total).alias("exact"), (F.sum(F.coalesce("likeness", F.lit(0.0)) * F.col("n")) / total).alias("likeness"))
    alone = actual.select(key).distinct().join(e.select(key).distinct(), key, "left_anti")
    both = got.unionByName(alone.select(key, F.lit(0.0).alias("exact"), F.lit(0.0).alias("likeness")))
    return both.select(key, "exact", "likeness", ((F.col("exact") + F.col("likeness")) / 2).alias("score"))
