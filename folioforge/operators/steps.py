"""The steps of a curation run that ask a model, as rows: request, reply, typed answer, usage.

A step builds one prompt for each row from a template, sends it through the model boundary
and reads the reply into a fixed shape, with that shape's default where it can't be read.
Usage comes out beside the answer, so that it is summed by a rollup and never in the driver.
"""

from __future__ import annotations

import re
import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.functions import replies
from folioforge.functions.text import fill_template, file_name, panel_label
from folioforge.operators.linkage import allowed_only
from folioforge.operators.model import ModelClient, RuleClient, complete_all

CAPTION = "figure_label string, caption_title string, figure_caption string, is_verbatim boolean"
PANELS = "array<struct<panel_label:string,panel_caption:string>>"
LABELLED = "panel_label string, panel_caption string"
#: What stands in for a caption that the model does not give.
NO_CAPTION = "Figure caption not found."
STEP_LOG = "run_id string, step string, critical boolean, started_at timestamp, elapsed_ms long, error string"


@dataclass(frozen=True)
class Step:
    """A named step: its template, with $name for each column, and how its reply is read."""

    name: str
    template: str
    read: Callable[[Column], Column]

    def run(self, rows: DataFrame, id_col: str, make_client: Callable[[], ModelClient] = RuleClient, **how: object) -> DataFrame:
        """(id, answer, step, prompt_tokens, completion_tokens, attempts, error): an answer for each
        row; rows whose columns are all null or empty are not sent and have the default."""
        names = sorted(set(re.findall(r"\$(\w+)", self.template)) & set(rows.columns))
        empty = F.concat_ws("", *names) == "" if names else F.lit(False)
        asked = rows.select(id_col, F.when(~empty, fill_template(self.template, {n: F.col(n) for n in names})).alias("prompt"))
        got = complete_all(asked, id_col, "prompt", make_client, **how)
        return got.select(F.col("request_id").alias(id_col), self.read(F.col("reply")).alias("answer"), F.lit(self.name).alias("step"), "prompt_tokens", "completion_tokens", "attempts", "error")


def _caption(reply: Column) -> Column:
    got = replies.typed(reply, CAPTION)
    found = F.coalesce(F.nullif(got["figure_caption"], F.lit("")), F.lit(NO_CAPTION))
    return F.struct(got["figure_label"].alias("figure_label"), F.coalesce(got["caption_title"], F.lit("")).alias("caption_title"), found.alias("figure_caption"), F.coalesce(got["is_verbatim"], F.lit(False)).alias("is_verbatim"))


def _panels(reply: Column) -> Column:
    """Panels of a reply, under panels or as a bare array, each label once, the first wins."""
    whole = replies.typed(reply, f"panels {PANELS}")["panels"]
    return F.coalesce(whole, replies.listed(reply, PANELS))


SECTIONS = Step("extract_sections", "Find the figure legends and the data availability section.\n$document", replies.sections)
CAPTIONS = Step("extract_individual_captions", "Find the caption of $figure_label.\n$all_captions", _caption)
PANEL_CAPTIONS = Step("extract_panels", "Part the caption of $figure_label by panels.\n$figure_caption", _panels)
DATA_SOURCES = Step("extract_data_sources", "List the data sources.\nRegistry: $registry\n$data_availability", replies.sources)
PANEL_FILES = Step("assign_panel_source", "Assign the files of $figure_label to its panels $panel_labels.\nFiles:\n$file_list", replies.files)
PANEL_MATCH = Step("match_caption_panel", "Which panel of this caption does the image show?\n$figure_caption\n$image", lambda reply: replies.typed(reply, LABELLED))
ALL_STEPS = (SECTIONS, CAPTIONS, PANEL_CAPTIONS, DATA_SOURCES, PANEL_FILES, PANEL_MATCH)


def assigned_panels(answers: DataFrame, id_col: str, allowed: DataFrame) -> DataFrame:
    """(id, panel_label, panel_caption, file): files that a model gave to panels, labels in one
    form, captions empty; only files that the request listed, allowed being (id, file)."""
    rows = answers.select(id_col, F.inline("answer.assigned_files")).select(id_col, panel_label(F.col("panel_label")).alias("panel_label"), F.explode("panel_sd_files").alias("file"))
    keyed = lambda df: df.withColumn("__k", F.struct(id_col, "file"))
    return allowed_only(keyed(rows), keyed(allowed), "__k").select(id_col, "panel_label", F.lit("").alias("panel_caption"), "file").distinct()


def registry_text(entries: DataFrame) -> str:
    """A short list of databases as JSON for a prompt; of no more entries than a prompt can hold."""
    row = entries.agg(F.to_json(F.array_sort(F.collect_list(F.struct(*sorted(entries.columns))))).alias("j")).first()
    return row["j"] if row else "[]"


def case_key(*parts: Column) -> Column:
    """The key under which the result of a case is kept: its parts by underscores, fit for a file."""
    return file_name(F.concat_ws("_", *[p.cast("string") for p in parts]))


def run_step(spark: SparkSession, log_path: str, run_id: str, name: str, run: Callable[[], DataFrame | None], critical: bool) -> DataFrame | None:
    """The result of a step, and a row of the step log for it.

    A step that fails leaves its error in the log; a critical one then fails the run, any
    other gives None. The log is Parquet that each step appends one row to.
    """
    started, began, error, result = time.time(), time.perf_counter(), None, None
    try:
        result = run()
    except Exception as e:
        error = f"{type(e).__name__}: {e}"
        if critical:
            raise
    finally:
        row = [(run_id, name, critical, started, int((time.perf_counter() - began) * 1000), error)]
        log = spark.createDataFrame(row, "run_id string, step string, critical boolean, s double, elapsed_ms long, error string")
        log.select("run_id", "step", "critical", F.timestamp_micros((F.col("s") * 1_000_000).cast("long")).alias("started_at"), "elapsed_ms", "error").coalesce(1).write.mode("append").parquet(log_path)
    return result
