"""Scores between texts, sets and lists."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def word_array(text: Column) -> Column:
    return F.filter(F.split(text, " "), lambda w: w != "")


def jaccard(a: Column, b: Column) -> Column:
    """Shared over all distinct elements; 1 for two empty sets, 0 for one."""
    both, either = F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))
    return F.when(either == 0, 1.0).otherwise(both / either)


def recall(expected: Column, actual: Column) -> Column:
    """Share of the expected elements that are there; 1 for two empty sets, 0 for one."""
    e, a = F.array_distinct(expected), F.array_distinct(actual)
    hit = F.size(F.array_intersect(e, a)) / F.greatest(F.size(e), F.lit(1))
    return F.when((F.size(e) == 0) & (F.size(a) == 0), 1.0).when((F.size(e) == 0) | (F.size(a) == 0), 0.0).otherwise(hit)


def positional(a: Column, b: Column) -> Column:
    """Equal elements at equal places over the length of the first list; 0 for an empty one."""
    pairs = F.zip_with(a, b, lambda x, y: F.coalesce((x == y).cast("int"), F.lit(0)))
    same = F.aggregate(F.slice(pairs, F.lit(1), F.size(a)), F.lit(0), lambda s, x: s + x)
    return F.when(F.size(a) == 0, 0.0).otherwise(same / F.size(a))


def ngrams(words: Column, n: int) -> Column:
    if n == 1:
        return words
    return F.when(F.size(words) >= n, F.transform(F.sequence(F.lit(0), F.size(words) - n), lambda i: F.array_join(F.slice(words, i + 1, n), " "))).otherwise(F.array().cast("array<string>"))


def overlap(df: DataFrame, key: str, a: str, b: str, n: int = 1) -> DataFrame:
    """(key, hits, n_a, n_b): n-grams of a that b has too, each at most as often as in b.

    The n-grams are counted by a shuffle on (key, n-gram), so long texts cost no more than
    their length; pairs without a single n-gram have zeros.
    """
    mark = lambda c, s: F.transform(ngrams(F.col(c), n), lambda g: F.struct(g.alias("g"), F.lit(s).alias("side")))
    per = df.select(key, F.inline(F.concat(mark(a, 0), mark(b, 1)))).groupBy(key, "g").agg(F.sum(1 - F.col("side")).alias("x"), F.sum("side").alias("y"))
    sums = per.groupBy(key).agg(F.sum(F.least("x", "y")).alias("hits"), F.sum("x").alias("n_a"), F.sum("y").alias("n_b"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
    return df.select(key).join(sums, key, "left").select(key, zero("hits"), zero("n_a"), zero("n_b"))


def bleu1(hits: Column, n_candidate: Column, n_reference: Column) -> Column:
    """Clipped precision with the brevity penalty; 0 for an empty side."""
    penalty = F.when(n_candidate >= n_reference, 1.0).otherwise(F.exp(1 - n_reference / n_candidate))
    return F.when((n_candidate == 0) | (n_reference == 0), 0.0).otherwise(penalty * hits / n_candidate)


def rouge(hits: Column, n_reference: Column, n_candidate: Column) -> Column:
    """F score of clipped overlap; 0 for an empty side."""
    return F.when(n_reference + n_candidate == 0, 0.0).otherwise(2 * hits / (n_reference + n_candidate))


def _places(a: Sequence) -> dict:
    """For each element the bits of the places where it stands."""
    places: dict = {}
    for i, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << i
    return places


def common_subsequence(a: Sequence, b: Sequence, places: dict | None = None) -> int:
    """Length of the longest common subsequence, all places of a at once as bits of a number."""
    places = _places(a) if places is None else places
    full = rest = (1 << len(a)) - 1
    for x in b:
        u = rest & places.get(x, 0)
        rest = ((rest + u) | (rest - u)) & full
    return len(a) - rest.bit_count()


def rouge_l(a: Column, b: Column) -> Column:
    """F score of the longest common subsequence of two word lists, on Arrow batches."""

    @F.pandas_udf("double")
    def score(x: pd.Series, y: pd.Series) -> pd.Series:
        out = []
        for p, q in zip(x, y):
            p, q = [] if p is None else list(p), [] if q is None else list(q)
            out.append(2 * common_subsequence(p, q) / (len(p) + len(q)) if len(p) + len(q) else 0.0)
        return pd.Series(out)

    return score(a, b)


def _shared_as_it_grows(a: str, b: str) -> list[int]:
    """Length of the longest common subsequence of a with each beginning of b."""
    places, full = _places(a), (1 << len(a)) - 1
    rest, out = full, []
    for x in b:
        u = rest & places.get(x, 0)
        rest = ((rest + u) | (rest - u)) & full
        out.append(len(a) - rest.bit_count())
    return out


def _at_either_end(short: str, long: str) -> float:
    """Best likeness with a stretch at an end of the longer text that is shorter than the other."""
    n = len(short)
    ends = (_shared_as_it_grows(short, long[: n - 1]), _shared_as_it_grows(short[::-1], long[: len(long) - n : -1] if n > 1 else ""))
    return max((2 * k / (n + m) for shared in ends for m, k in enumerate(shared, 1)), default=0.0)


def partial_ratio(short: str, long: str) -> float:
    """Best likeness, 0 to 100, of the shorter text with a stretch of the longer: twice the
    longest common subsequence over both lengths. Stretches are as long as the shorter text,
    or shorter at either end. Two stretches k places apart differ by at most k, so most places
    are skipped and the result is still the best of all. Of two equally long texts each is
    taken for the shorter."""
    if len(short) > len(long):
        short, long = long, short
    n = len(short)
    if not n:
        return 0.0
    if short in long:
        return 100.0
    places, best, at = _places(short), 0, 0
    while at + n <= len(long):
        here = common_subsequence(short, long[at : at + n], places)
        best = max(best, here)
        at += best - here + 1
    ends = [_at_either_end(short, long)] + ([_at_either_end(long, short)] if len(long) == n else [])
    return 100 * max(best / n, *ends)


def invention_score(extracted: Column, source: Column) -> Column:
    """0 for a text close to a stretch of its source, up to 1 for one that has nothing of it.
    For texts already known not to be verbatim; from a similarity of 98 on it is 0."""

    @F.pandas_udf("double")
    def score(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([1.0 if not p or not q else 0.0 if (r := partial_ratio(p, q)) >= 98 else 1 - r / 100 for p, q in zip(x, y)])

    return score(extracted, source)
