"""Totals, descriptions and status folds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usage_rollup(calls: DataFrame, keys: list[str]) -> DataFrame:
    """Calls and tokens by all leading key sets up to the grand total; is_total counts the keys
    summed away. The total of tokens is that of prompt and completion tokens."""
    got = calls.rollup(*keys).agg(F.count("*").alias("n_calls"), F.sum("prompt_tokens").alias("prompt_tokens"), F.sum("completion_tokens").alias("completion_tokens"), F.grouping_id().alias("gid"))
    return got.withColumn("total_tokens", F.col("prompt_tokens") + F.col("completion_tokens")).withColumn("is_total", F.bit_count("gid").cast("bigint")).drop("gid")


def describe(df: DataFrame, keys: list[str], value: Column, digits: int = 6) -> DataFrame:
    """Count, mean, deviation, least, quartiles (exact, interpolated) and greatest by group."""
    v = value.cast("double")
    r = lambda c: F.round(c, digits)
    return df.groupBy(*keys).agg(
        F.count(v).alias("n"), r(F.avg(v)).alias("mean"), r(F.stddev_samp(v)).alias("std"), r(F.min(v)).alias("min"),
        r(F.percentile(v, F.lit(0.25))).alias("p25"), r(F.percentile(v, F.lit(0.5))).alias("p50"), r(F.percentile(v, F.lit(0.75))).alias("p75"), r(F.max(v)).alias("max"),
    )


def fold_status(checks: DataFrame, keys: list[str], outcome: str) -> DataFrame:
    """The worst outcome of a group: error over failed over passed; no row, no group."""
    worst = F.max(F.when(F.col(outcome) == "error", 2).when(F.col(outcome) == "failed", 1).otherwise(0))
    count = lambda x: F.sum((F.col(outcome) == x).cast("bigint")).alias("n_" + x)
    got = checks.groupBy(*keys).agg(worst.alias("w"), count("passed"), count("failed"), count("error"))
    return got.withColumn("status", F.when(F.col("w") == 2, "error").when(F.col("w") == 1, "degraded").otherwise("success")).drop("w")
