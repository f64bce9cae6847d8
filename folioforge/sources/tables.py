"""Parquet tables: the one source every query reads."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table `name` of a data directory; column pruning and filters reach the scan."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


FIGURES = "label string, image string, caption string"


def read_figures(spark: SparkSession, path: str) -> DataFrame:
    """(label, image, caption) of files that hold one JSON array of triples each. A path without
    files, a file that is no such array and an element that is no triple give no row."""
    try:
        files = spark.read.text(path, wholetext=True)
    except AnalysisException:
        return spark.createDataFrame([], FIGURES)
    triples = files.select(F.explode(F.from_json("value", "array<array<string>>")).alias("t")).where(F.size("t") == 3)
    return triples.select(*[F.col("t")[k].alias(c.split()[0]) for k, c in enumerate(FIGURES.split(", "))])


def read_ground_truth(spark: SparkSession, path: str, wanted: DataFrame, id_col: str = "manuscript_id") -> DataFrame:
    """(id, document, error): the JSON file named after each wanted id; error where there is none,
    or where it is no JSON."""
    files = spark.read.option("pathGlobFilter", "*.json").text(path, wholetext=True).select(F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.json$", 1).alias(id_col), "value")
    got = wanted.select(id_col).distinct().join(files, id_col, "left")
    error = F.when(F.col("value").isNull(), "missing").when(F.try_parse_json("value").isNull(), "no JSON")
    return got.select(id_col, F.when(error.isNull(), F.col("value")).alias("document"), error.alias("error"))
