"""Keeping one row of several: best, first, latest, nearest; and what becomes of the others.

All of them aggregate before they shuffle: the winner of a group is found by min_by or
max_by with map-side combining, never by collecting or sorting the group.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioforge.functions.sequence import LETTERS
from folioforge.operators.partitioning import salt_count

#: Rows of one group that one task ranks.
ROWS_PER_PART = 1_000_000


def keep_best(df: DataFrame, keys: list[str], score: Column, order: Column, place: str | None = None) -> DataFrame:
    """The row of the highest score of each group, the first in order among equals.

    Null scores lose to all others; null keys form a group. With `place`, the column of
    that name has the order of the group's first row, where the winner stands.
    """
    row = F.struct(*df.columns)
    best = F.max_by(row, F.struct(score.isNotNull(), score, -order)).alias("best")
    extra = [F.min(order).alias(place)] if place else []
    return df.groupBy(*keys).agg(best, *extra).select("best.*", *([place] if place else []))


def first_and_rest(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """All rows with is_first: whether the row is the first of its group.

    The first is found by aggregation and joined back, so no group is sorted in one task.
    """
    firsts = df.groupBy(*[F.col(k).alias(f"__{k}") for k in keys]).agg(F.min(order).alias("__first"))
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys))
    return df.join(firsts, same).select(*df.columns, (F.col(order) == F.col("__first")).alias("is_first"))


def latest(df: DataFrame, keys: list[str], *order: str) -> DataFrame:
    """The last row of each group by the order columns; a null counts as the earliest."""
    return df.groupBy(*keys).agg(F.max_by(F.struct(*df.columns), F.struct(*order)).alias("r")).select("r.*")


def nearest_to_group(points: DataFrame, key: str, id_col: str, coordinates: list[Column], digits: int = 6) -> DataFrame:
    """(key, id, distance, is_winner): squared distance to the group's mean point; the nearest
    point, by id among equals, wins and the others are the group's conflicts."""
    names = [f"x{i}" for i in range(len(coordinates))]
    flat = points.select(key, id_col, *[c.cast("double").alias(n) for c, n in zip(coordinates, names)])
    means = flat.groupBy(key).agg(*[F.avg(n).alias("m_" + n) for n in names])
    distance = reduce(lambda a, b: a + b, ((F.col(n) - F.col("m_" + n)) * (F.col(n) - F.col("m_" + n)) for n in names))
    far = flat.join(means, key).select(key, id_col, F.round(distance, digits).alias("distance"))
    won = far.groupBy(key).agg(F.min_by(id_col, F.struct("distance", id_col)).alias("winner"))
    return far.join(won, key).select(key, id_col, "distance", (F.col(id_col) == F.col("winner")).alias("is_winner"))


def nearest_to_original(points: DataFrame, originals: DataFrame, key: str, id_col: str, coordinates: list[str], confidence: str) -> DataFrame:
    """(key, id, distance, is_winner): squared distance to the original point of the key, of which
    originals has at most one; the nearest point, by id among equals, wins. Where the key has no
    original point, distance is null and the highest confidence wins."""
    at = originals.select(key, *[F.col(c).cast("double").alias(f"__{c}") for c in coordinates])
    apart = reduce(lambda a, b: a + b, ((F.col(c) - F.col(f"__{c}")) * (F.col(c) - F.col(f"__{c}")) for c in coordinates))
    far = points.join(at, key, "left").select(key, id_col, confidence, apart.alias("distance"))
    order = F.struct(F.col("distance").isNull(), "distance", F.when(F.col("distance").isNull(), F.struct(F.col(confidence).isNull(), -F.col(confidence))), id_col)
    won = far.groupBy(key).agg(F.min_by(id_col, order).alias("winner"))
    return far.join(won, key).select(key, id_col, "distance", (F.col(id_col) == F.col("winner")).alias("is_winner"))


def free_labels(df: DataFrame, group: str, order: str, label: str) -> DataFrame:
    """(group, order, new_label) for each row without a label: the next letters not in use in
    its group, A to Z, then AA to ZZ, then unknown, after all named labels are taken.

    Used labels are collected as a set of at most 702 strings, so a hot group stays small. Only
    the first 702 rows without a label can get one: a hot group is dealt out, each part keeps
    its own first 702, and only those are ranked together.
    """
    labels = list(LETTERS) + [a + b for a in LETTERS for b in LETTERS]
    blank = F.col(label).isNull() | (F.trim(label) == "")
    all_labels = F.array(*[F.lit(x) for x in labels])
    used = df.where(~blank).groupBy(group).agg(F.collect_set(F.when(F.upper(F.trim(label)).isin(labels), F.upper(F.trim(label)))).alias("used"))
    pending = df.where(blank).select(group, order)
    sizes = pending.groupBy(F.col(group).alias("__group")).agg(salt_count(F.count("*"), ROWS_PER_PART).alias("__parts"))
    dealt = pending.join(sizes, F.col(group).eqNullSafe(F.col("__group"))).withColumn("__part", F.pmod(F.xxhash64(order), "__parts"))
    near = dealt.withColumn("__k", F.row_number().over(Window.partitionBy(group, "__part").orderBy(order)))
    first = near.where(F.col("__k") <= len(labels)).select(group, order, F.row_number().over(Window.partitionBy(group).orderBy(order)).alias("k"))
    ranked = first.unionByName(near.where(F.col("__k") > len(labels)).select(group, order, F.lit(len(labels) + 1).alias("k")))
    free = F.array_except(all_labels, F.coalesce("used", F.array().cast("array<string>")))
    return ranked.join(used, group, "left").select(group, order, F.coalesce(F.try_element_at(free, F.col("k")), F.lit("unknown")).alias("new_label"))


def gaps(df: DataFrame, group: str, number: str) -> DataFrame:
    """(group, gap_from, gap_to): runs of missing numbers between the least and the greatest of
    each group, from distinct numbers and their successors."""
    distinct = df.where(F.col(number).isNotNull()).select(group, number).distinct()
    after = F.lead(number).over(Window.partitionBy(group).orderBy(number))
    return distinct.withColumn("after", after).where(F.col("after") > F.col(number) + 1).select(group, (F.col(number) + 1).alias("gap_from"), (F.col("after") - 1).alias("gap_to"))


