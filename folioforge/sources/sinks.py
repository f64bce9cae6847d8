"""Sinks: nested JSON, payload files, results by key."""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from pathlib import Path

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.functions.text import file_name


def pruned_json(scalars: dict[str, Column], arrays: dict[str, Column], keep_empty: tuple[str, ...] = ("sd_files",)) -> Column:
    """An object as JSON text without nulls and empty arrays, but for the arrays to keep."""
    kept = [c.alias(n) for n, c in scalars.items()]
    kept += [(c if n in keep_empty else F.when(F.size(c) > 0, c)).alias(n) for n, c in arrays.items()]
    return F.to_json(F.struct(*kept))


def with_context(line: Column, context: Column) -> Column:
    """A line with key=value pairs after it, in the order of the keys; nulls left out."""
    pairs = F.array_sort(F.map_entries(F.map_filter(context, lambda k, v: v.isNotNull())))
    return F.concat_ws(" ", line, F.array_join(F.transform(pairs, lambda e: F.concat_ws("=", e["key"], e["value"])), " "))


def html_rows(df: DataFrame, columns: list[str], most: int = 500) -> DataFrame:
    """Rows of an HTML table, cells escaped and cut to a readable length."""
    def cell(name: str) -> Column:
        s = F.coalesce(F.col(name).cast("string"), F.lit(""))
        s = F.when(F.char_length(s) > most, F.concat(F.substring(s, 1, most), F.lit("…"))).otherwise(s)
        for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
            s = F.replace(s, F.lit(a), F.lit(b))
        return F.concat(F.lit("<td>"), s, F.lit("</td>"))

    return df.select(F.concat(F.lit("<tr>"), *[cell(c) for c in columns], F.lit("</tr>")).alias("value"))


def whole_json(value: Column) -> Column:
    """A struct as JSON text with all its fields, nulls too."""
    return F.to_json(value, {"ignoreNullFields": "false"})


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def append_results(df: DataFrame, path: str, keys: list[str] | None = None) -> None:
    """Results as Parquet files; a failed job leaves none of its files visible. With keys, results
    of a key that is there already are left out, and of several new ones one is kept."""
    if keys:
        try:
            df = df.dropDuplicates(keys).join(df.sparkSession.read.parquet(path).select(*keys).distinct(), keys, "left_anti")
        except AnalysisException:  # nothing there yet
            df = df.dropDuplicates(keys)
    df.write.mode("append").parquet(path)


PAYLOADS = "name string, kind string, bytes long"


def write_payloads(df: DataFrame, folder: str, label: str, payload: str, caption: str) -> DataFrame:
    """(name, kind, bytes): the image of each row, base64 with or without a data URL's head, and its
    caption, as files named after the label in a folder that all workers share. Payloads that are
    no base64 give an error instead of a file. One file is one row's; nothing is collected."""
    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        Path(folder).mkdir(parents=True, exist_ok=True)
        for b in batches:
            out = []
            for name, data, text in zip(b["name"], b["payload"], b["caption"]):
                try:
                    raw = base64.b64decode(re.sub(r"^data:[^,]*,", "", data or ""), validate=True)
                except ValueError:
                    out.append((name, "error", 0))
                    continue
                Path(folder, f"{name}.png").write_bytes(raw)
                Path(folder, f"{name}.txt").write_text(text or "")
                out += [(f"{name}.png", "image", len(raw)), (f"{name}.txt", "caption", len((text or "").encode()))]
            yield pd.DataFrame(out, columns=["name", "kind", "bytes"])

    rows = df.select(file_name(F.col(label)).alias("name"), F.col(payload).alias("payload"), F.col(caption).alias("caption"))
    return rows.mapInPandas(write, PAYLOADS)


def payload_properties(df: DataFrame, label: str, payload: str) -> DataFrame:
    """Number of rows, of payloads that are there and of distinct labels, and their least and
    greatest length."""
    n = F.length(F.nullif(F.col(payload), F.lit("")))
    return df.agg(F.count("*").alias("n"), F.count(n).alias("n_payloads"), F.countDistinct(label).alias("n_labels"), F.min(n).alias("least"), F.max(n).alias("most"))
