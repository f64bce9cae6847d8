"""How rows are laid over tasks: spreading small inputs, salting hot groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of one group that one task may hold before the group is salted.
ROWS_PER_SALT = 20_000


def spread(df: DataFrame) -> DataFrame:
    """df over at least as many partitions as the cluster has cores.

    A scan of few files feeds costly per-row work through few tasks; only then are the rows
    dealt out anew. A scan that already has enough partitions is left alone: no shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def salt_count(rows: Column, rows_per_salt: int = ROWS_PER_SALT) -> Column:
    """Number of salts of a group of so many rows: 1 unless the group is hot."""
    return F.ceil(F.greatest(rows, F.lit(1)) / F.lit(rows_per_salt)).cast("int")
