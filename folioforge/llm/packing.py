"""Texts into containers of fixed capacity by hierarchical residual packing.

Each partition packs its items best-fit, a bounded number at a time, the largest first.
Nearly full bins are final; the others go on as items of their own to fewer partitions,
where they are packed again, and so on up the tree until one partition has packed them all.
Where the underfull bins are more than one task may hold, they are dealt out anew in each
round, until two rounds in a row leave as many as there were.
"""

from __future__ import annotations

import base64
import importlib.util
import os
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.operators.partitioning import spread
from folioforge.session import materialize

TOKENIZERS = "/opt/tokenizers"
#: A bin with at most this share of its capacity unused is final.
UNUSED_SHARE = 0.02
#: Partitions that merge into one on each level, and items that a task packs at a time.
FAN_IN, BINS_PER_TASK = 8, 500_000


@lru_cache(maxsize=2)
def encoding(folder: str = TOKENIZERS):
    """The byte-level BPE of 50,256 ranks in a folder of public tokenizers."""
    import tiktoken

    spec = importlib.util.spec_from_file_location("public_tokenizers_at", os.path.join(folder, "__init__.py"))
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    with open(os.path.join(folder, "byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("byte_bpe_50k", pat_str=module.PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_counts(df: DataFrame, id_col: str, text: str, folder: str = TOKENIZERS) -> DataFrame:
    """(id, size): tokens of each text; null and empty texts have 0."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoding(folder)
        for b in batches:
            for k in range(0, len(b), 256):  # few texts at a time: token lists are large
                part = b.iloc[k : k + 256]
                texts = [t if isinstance(t, str) else "" for t in part["text"]]
                yield pd.DataFrame({"id": part["id"].to_numpy(), "size": [len(x) for x in enc.encode_ordinary_batch(texts, num_threads=1)]})

    rows = spread(df.select(F.col(id_col).alias("id"), F.col(text).alias("text")))
    return rows.mapInPandas(count, f"id {df.schema[id_col].dataType.simpleString()}, size long")


def best_fit(sizes: list[int], capacity: int) -> list[int]:
    """A bin number for each size, taken in the given order: into the bin that it leaves
    fullest, or a new one. Bins are kept by free space; a bit mask finds the tightest."""
    free: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_spaces, bins, out = 0, 0, []
    for s in sizes:
        fitting = open_spaces >> s
        if fitting:
            space = s + (fitting & -fitting).bit_length() - 1
            b = free[space].pop()
            if not free[space]:
                open_spaces ^= 1 << space
        else:
            space, b = capacity, bins
            bins += 1
        out.append(b)
        left = space - s
        if not free[left]:
            open_spaces |= 1 << left
        free[left].append(b)
    return out


def _packed(rows: pd.DataFrame, capacity: int, level: int) -> pd.DataFrame:
    rows = rows.sort_values(["size", "item"], ascending=[False, True], ignore_index=True)  # the same bins if a task is run again
    bins = pd.Series(best_fit(rows["size"].tolist(), capacity))
    rows["bin"] = f"L{level}:" + rows["item"].groupby(bins).transform("first")  # a bin is named after its first item, so no two share a name
    rows["fill"] = rows["size"].groupby(bins).transform("sum").astype("int64")
    return rows


def _pack_round(capacity: int, level: int, most: int):
    """Best-fit within each partition, at most so many items at a time: (item, size) -> (item, size, bin, fill)."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, n = [], 0
        for b in batches:
            held.append(b)
            n += len(b)
            if n >= most:
                yield _packed(pd.concat(held, ignore_index=True), capacity, level)
                held, n = [], 0
        if n:
            yield _packed(pd.concat(held, ignore_index=True), capacity, level)

    return pack


def pack(items: DataFrame, capacity: int, unused_share: float = UNUSED_SHARE, fan_in: int = FAN_IN, bins_per_task: int = BINS_PER_TASK) -> DataFrame:
    """(item, size) with 0 <= size <= capacity -> (item, size, bin, fill), bin names unique.

    Items are strings, unique. Rounds end when one partition packed all underfull bins, or
    when those are too many for one task and two rounds in a row, each over other
    neighbours, brought none of them together.
    """
    full = capacity - int(capacity * unused_share)
    schema = "item string, size long, bin string, fill long"
    first = materialize(items.select("item", F.col("size").cast("bigint").alias("size")).mapInPandas(_pack_round(capacity, 0, bins_per_task), schema))
    parts = max(2, first.rdd.getNumPartitions())  # of the written rows; a partition may have packed in several goes
    packed, uppers, before, idle = first, [], None, 0
    while True:
        bins = packed.where(F.col("fill") < full).groupBy("bin").agg(F.first("fill").alias("size")).select(F.col("bin").alias("item"), "size")
        n = bins.count()
        idle = idle + 1 if n == before else 0
        if n < 2 or idle == 2:
            break
        parts, before = max(-(-parts // fan_in), -(-n // bins_per_task), 1), n
        packed = materialize(bins.repartition(parts, F.xxhash64("item", F.lit(len(uppers)))).mapInPandas(_pack_round(capacity, len(uppers) + 1, bins_per_task), schema))
        uppers.append(packed)
        if parts == 1 and n <= bins_per_task:
            break
    # Names are followed from the top down among the few underfull bins, then once for all items.
    top = None
    for level in reversed(uppers):
        step = level.select(F.col("item").alias("lower"), "bin", "fill")
        if top is not None:
            step = step.join(top.select(F.col("lower").alias("bin"), F.col("bin").alias("up"), F.col("fill").alias("up_fill")), "bin", "left").select("lower", F.coalesce("up", "bin").alias("bin"), F.coalesce("up_fill", "fill").alias("fill"))
        top = step
    if top is None:
        return first
    joined = first.join(top.select(F.col("lower").alias("bin"), F.col("bin").alias("up"), F.col("fill").alias("up_fill")), "bin", "left")
    return joined.select("item", "size", F.coalesce("up", "bin").alias("bin"), F.coalesce("up_fill", "fill").alias("fill"))


def pack_texts(df: DataFrame, id_col: str, text: str, capacity: int, folder: str = TOKENIZERS, **how: float) -> DataFrame:
    """(id, part_no, n_tokens, container, container_tokens): a container for every text.

    Only a text larger than the capacity is divided: into parts of `capacity` tokens, the
    last part being the rest; part k holds its tokens (k - 1) * capacity and on. Null and
    empty texts take no space but get a container. Repeated texts are items of their own.
    """
    if capacity < 1:
        raise ValueError("the capacity must be positive")
    sizes = token_counts(df, id_col, text, folder)
    n_parts = F.greatest(F.lit(1), F.ceil(F.col("size") / F.lit(capacity)).cast("int"))
    parts = sizes.select("id", "size", F.explode(F.sequence(F.lit(1), n_parts)).alias("part_no"))
    here = F.least(F.lit(capacity), F.col("size") - (F.col("part_no") - 1) * capacity)
    items = parts.select(F.concat_ws("/", F.col("id").cast("string"), F.col("part_no").cast("string")).alias("item"), here.alias("size"))
    packed = pack(items, capacity, **how)
    kind = df.schema[id_col].dataType
    name = F.regexp_extract("item", r"^(.*)/(\d+)$", 1)
    return packed.select(name.cast(kind).alias(id_col), F.regexp_extract("item", r"/(\d+)$", 1).cast("int").alias("part_no"), F.col("size").alias("n_tokens"), F.col("bin").alias("container"), F.col("fill").alias("container_tokens"))
