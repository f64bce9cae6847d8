"""Ordered items into chunks under a token limit, greedily, without collecting a group."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def chunk(items: DataFrame, group: str, order: str, size: str, limit: int) -> DataFrame:
    """(group, order, size, chunk_no): the next item joins the open chunk if the sum stays within
    the limit; an item beyond the limit closes the chunk, stands alone and starts afresh.

    Greedy packing depends on all items before, so a group's items pass one task in order;
    they stream through it batch by batch, sorted by Spark with spilling, and only the open
    chunk's sum is remembered. Null sizes count as 0; groups may be of any size.
    """
    rows = items.select(F.col(group).cast("string").alias("g"), F.col(order).cast("bigint").alias("o"), F.coalesce(F.col(size).cast("bigint"), F.lit(0)).alias("size"))

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, open_sum, number, fresh = None, 0, 0, True
        for b in batches:
            out = []
            for g, s in zip(b["g"], b["size"]):
                if g != current:
                    current, open_sum, number, fresh = g, 0, 0, True
                if s > limit:
                    number += 1
                    fresh, open_sum = True, 0
                elif fresh or open_sum + s > limit:
                    number += 1
                    fresh, open_sum = False, s
                else:
                    open_sum += s
                out.append(number)
            yield b.assign(chunk_no=out)

    laid = rows.repartition(F.col("g")).sortWithinPartitions("g", "o")
    return laid.mapInPandas(pack, "g string, o bigint, size bigint, chunk_no int").select(F.col("g").cast(items.schema[group].dataType).alias(group), F.col("o").alias(order), "size", "chunk_no")


def chunk_prompts(prompts: DataFrame, id_col: str, prompt: str, marker: str, limit: int, buffer: int = 100) -> DataFrame:
    """(id, chunk_no, n_lines, prompt): a prompt with a list after a marker taken apart into
    prompts that repeat what stands before the list and hold as many lines as the limit lets.

    The limit is lessened by the tokens of the fixed part and a buffer. A prompt without the
    marker, or with an empty list, is one chunk as it stands. A prompt is one model request and
    its lines are joined again in their order, so a chunk is never larger than the limit or
    one line.
    """
    at = F.instr(F.col(prompt), marker)
    head = F.when(at > 0, F.substring(F.col(prompt), F.lit(1), at + len(marker) - 1)).otherwise(F.lit(""))
    tail = F.when(at > 0, F.substring(F.col(prompt), at + len(marker), F.length(prompt))).otherwise(F.col(prompt))
    lines = F.filter(F.split(tail, "\n"), lambda x: F.trim(x) != "")
    rows = prompts.select(id_col, head.alias("head"), F.posexplode_outer(F.when(at > 0, lines).otherwise(F.array(F.col(prompt)))).alias("k", "line"))
    rows = rows.withColumns({"k": F.coalesce("k", F.lit(0)), "line": F.coalesce("line", F.lit(""))})
    # the fixed part weighs on every line's budget alike, so sizes are scaled instead of the limit
    room = F.greatest(F.lit(1), F.lit(limit - buffer) - F.floor(F.char_length("head") / 4))
    sized = rows.withColumn("size", F.ceil((F.floor(F.char_length("line") / 4) + 1) * 1_000_000 / room))
    numbered = chunk(sized, id_col, "k", "size", 1_000_000).select(id_col, "k", "chunk_no")
    got = rows.join(numbered, [id_col, "k"]).groupBy(id_col, "chunk_no").agg(F.first("head").alias("head"), F.count("*").alias("n_lines"), F.array_sort(F.collect_list(F.struct("k", "line"))).alias("r"))
    return got.select(id_col, "chunk_no", "n_lines", F.concat_ws("\n", F.nullif("head", F.lit("")), F.array_join("r.line", "\n")).alias("prompt"))
