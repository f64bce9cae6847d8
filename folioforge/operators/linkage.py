"""Joins: containment, prefix, upsert, allow-list, fallback, work still to do."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.operators.partitioning import salt_count
from folioforge.session import materialize

#: Rows that a dimension may have to be sent to every task; a longer one is joined by a shuffle.
BROADCAST_ROWS = 50_000
#: Rows of one key that meet as many of the other side in one task, where all pairs of a key are made.
ROWS_PER_MEETING = 1_000


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """df marked for broadcast if a count proves it small, else as it is."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def contained(extracts: DataFrame, sources: DataFrame, key: str, extract: str, source: str) -> DataFrame:
    """extracts with is_verbatim: whether the extract stands in the source of its key.

    At most one source a key is joined, so a hot key costs one comparison for each of its
    extracts; extracts without a source, and empty ones, are not verbatim.
    """
    joined = extracts.join(sources.select(key, F.col(source).alias("__source")), key, "left")
    hit = F.contains(F.col("__source"), F.col(extract)) & (F.length(extract) > 0)
    return joined.withColumn("is_verbatim", F.coalesce(hit, F.lit(False))).drop("__source")


def meet(left: DataFrame, right: DataFrame, key: str, by_left: str, by_right: str, rows: int = ROWS_PER_MEETING) -> DataFrame:
    """All pairs of rows of both sides that share a key.

    A hot key is dealt out on either side by the hash of the column named, into parts of about
    `rows` rows, and each part of the one side meets each part of the other in a task of its own.
    """
    sizes = left.groupBy(key).agg(salt_count(F.count("*"), rows).alias("__m")).join(right.groupBy(key).agg(salt_count(F.count("*"), rows).alias("__n")), key)
    part = lambda c, n: F.pmod(F.xxhash64(c), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    a = left.join(sizes, key).withColumn("__i", part(by_left, "__m")).withColumn("__j", every("__n")).drop("__m", "__n")
    b = right.join(sizes, key).withColumn("__j", part(by_right, "__n")).withColumn("__i", every("__m")).drop("__m", "__n")
    return a.join(b, [key, "__i", "__j"]).drop("__i", "__j")


def contained_in_any(extracts: DataFrame, sources: DataFrame, key: str, extract: str, source: str) -> DataFrame:
    """extracts with is_verbatim: whether the extract stands in any source of its key.

    Each distinct extract meets each distinct source of its key once; extracts without a
    source, and empty ones, are not verbatim.
    """
    asked = extracts.select(key, extract).where(F.length(extract) > 0).distinct()
    texts = sources.select(key, F.col(source).alias("__source")).where("__source IS NOT NULL").distinct()
    hits = meet(asked, texts, key, extract, "__source").where(F.contains("__source", extract)).select(key, extract).distinct()
    return extracts.join(hits.withColumn("__hit", F.lit(True)), [key, extract], "left").withColumn("is_verbatim", F.coalesce("__hit", F.lit(False))).drop("__hit")


def pair_accuracy(df: DataFrame, key: str, expected: str, name: str, exact: list[str]) -> DataFrame:
    """(key, accuracy): mean field matches over all pairs of expected and actual rows of a key,
    by its number of expected rows; may exceed 1.

    The exact fields match by equality, nulls too: equal values are counted on either side and
    multiplied, so no pair is made. Names match where either, in lower case, contains the
    other: only the distinct names of a key meet, weighted by their counts.
    """
    fields = F.array(F.struct(F.lit(0).alias("field"), F.lower(name).alias("value")), *[F.struct(F.lit(k).alias("field"), F.col(c).cast("string").alias("value")) for k, c in enumerate(exact, 1)])
    marked = df.select(key, F.col(expected).cast("bigint").alias("__e"), F.inline(fields))
    counted = materialize(marked.groupBy(key, "field", "value").agg(F.sum("__e").alias("__e"), F.sum(1 - F.col("__e")).alias("__a")))
    # the rows expected are those of any one field
    sums = counted.groupBy(key).agg(F.sum(F.col("__e") * F.col("__a")).alias("__hits"), F.greatest(F.sum(F.when(F.col("field") == 0, F.col("__e"))), F.lit(1)).alias("__n"))
    names = counted.where("field = 0 AND value IS NOT NULL")
    left, right = names.where("__e > 0").select(key, F.col("value").alias("__x"), "__e"), names.where("__a > 0").select(key, F.col("value").alias("__y"), "__a")
    partial = meet(left, right, key, "__x", "__y").where("__x <> __y AND (contains(__x, __y) OR contains(__y, __x))").groupBy(key).agg(F.sum(F.col("__e") * F.col("__a")).alias("__more"))
    return sums.join(partial, key, "left").select(key, ((F.col("__hits") + F.coalesce("__more", F.lit(0))) / (len(exact) + 1) / F.col("__n")).alias("accuracy"))


def longest_prefix(df: DataFrame, value: str, dimension: DataFrame, prefix: str, columns: list[str]) -> DataFrame:
    """df with the columns of the longest entry that begins the value; null where none does.

    An equi-join: each distinct value is taken apart into its beginnings of the lengths that
    occur in the dimension, instead of being compared with every entry.
    """
    lengths = sorted(r[0] for r in dimension.select(F.length(prefix)).distinct().collect() if r[0])  # no more than the longest entry has letters
    n = F.explode(F.filter(F.lit(lengths) if lengths else F.array().cast("array<int>"), lambda k: k <= F.length(value)))
    begun = df.select(value).where(F.col(value).isNotNull()).distinct().select(value, n.alias("n")).withColumn("__p", F.expr(f"substring({value}, 1, n)"))
    hits = begun.join(dimension.select(F.col(prefix).alias("__p"), *columns), "__p")
    best = hits.groupBy(value).agg(F.max_by(F.struct(*columns), F.struct("n")).alias("hit"))
    return df.join(best, value, "left").select(*df.columns, *[F.col(f"hit.{c}").alias(c) for c in columns])


def upsert(old: DataFrame, new: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Rows of both sides by key; where both have a key, the new values that are not null win."""
    a, b = old.select(*keys, *[F.col(v).alias(f"__old_{v}") for v in values]), new.select(*keys, *[F.col(v).alias(f"__new_{v}") for v in values])
    return a.join(b, keys, "full").select(*keys, *[F.coalesce(f"__new_{v}", f"__old_{v}").alias(v) for v in values])


def unmatched_kept(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of both sides with where they occur: both, left or right."""
    a, b = left.select(*keys).distinct().withColumn("__l", F.lit(1)), right.select(*keys).distinct().withColumn("__r", F.lit(1))
    side = F.when(F.col("__l").isNull(), "right").when(F.col("__r").isNull(), "left").otherwise("both")
    return a.join(b, keys, "full").select(*keys, side.alias("side"))


def allowed_only(df: DataFrame, allowed: DataFrame, on: str) -> DataFrame:
    return df.join(allowed.select(on).distinct(), on, "left_semi")


def expected_only(df: DataFrame, expected: DataFrame, key: str, on: str) -> DataFrame:
    """Rows whose value is in the expected list of their key; all rows of a key without a list."""
    listed = df.join(expected.select(key, on).distinct(), [key, on], "left_semi")
    return listed.select(*df.columns).unionByName(df.join(expected.select(key).distinct(), key, "left_anti").select(*df.columns))


def todo(grid: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Cases of the grid without a result yet."""
    return grid.join(done.select(*keys), keys, "left_anti")


def by_priority(candidates: DataFrame, keys: list[str], priority: str) -> DataFrame:
    """The candidate of the least priority number of each key."""
    return candidates.groupBy(*keys).agg(F.min_by(F.struct(*candidates.columns), F.struct(priority)).alias("r")).select("r.*")


def literal_prefix(pattern: Column) -> Column:
    """The letters, digits and plain signs that any match of a pattern begins with; empty where
    the pattern has alternatives or begins with anything else."""
    plain = F.regexp_extract(F.regexp_replace(pattern, r"^\^", ""), r"^([A-Za-z0-9_ :/-]*)(?![?*+{])", 1)
    return F.when(pattern.contains("|"), "").otherwise(plain)


def pattern_matches(values: DataFrame, value: str, patterns: DataFrame, pattern: str, columns: list[str]) -> DataFrame:
    """Distinct values with every entry whose pattern they match as a whole.

    Patterns stand under their literal beginning; each distinct value is taken apart into its
    beginnings of the lengths that occur, joined on equality, and only patterns met there
    are tried. Patterns without a literal beginning are tried on every value.
    """
    listed = patterns.select(F.col(pattern).alias("__pattern"), *columns).where("__pattern IS NOT NULL").withColumn("__p", literal_prefix(F.col("__pattern")))
    lengths = sorted(r[0] for r in listed.select(F.length("__p")).distinct().collect())  # no more than the longest pattern has signs
    distinct = values.select(value).where(F.col(value).isNotNull()).distinct()
    n = F.explode(F.filter(F.lit(lengths) if lengths else F.array().cast("array<int>"), lambda k: k <= F.length(value)))
    begun = distinct.select(value, n.alias("__n")).withColumn("__p", F.expr(f"substring({value}, 1, __n)"))
    hits = begun.join(small(listed), "__p").where(F.expr(f"{value} RLIKE concat('^(?:', __pattern, ')$')"))
    return hits.select(value, *columns)
