"""Detected panels and the panels a figure is known to have: conflicts, free labels, leftovers."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.functions.sequence import LETTERS

BOX = ["x1", "y1", "x2", "y2"]
#: All labels that can be given out, in order.
ALL_LABELS = [*LETTERS, *(a + b for a in LETTERS for b in LETTERS)]
PANELS = "figure string, place long, panel_label string, panel_caption string, x1 double, y1 double, x2 double, y2 double, confidence double, origin string"


def _apart(a: str, b: str) -> Column:
    """Squared distance of the centres of two boxes given as structs."""
    off = lambda lo, hi: (F.col(f"{a}.{lo}") + F.col(f"{a}.{hi}")) / 2 - (F.col(f"{b}.{lo}") + F.col(f"{b}.{hi}")) / 2
    return off("x1", "x2") * off("x1", "x2") + off("y1", "y2") * off("y1", "y2")


def _groups(matches: DataFrame, originals: DataFrame) -> DataFrame:
    """For each figure and label in upper case: the first match, the known panel and the winner."""
    named = matches.where(F.trim("panel_label") != "").withColumn("key", F.upper("panel_label"))
    known = originals.withColumn("key", F.upper("panel_label")).groupBy("figure", "key").agg(F.max_by(F.struct("panel_label", "panel_caption", F.struct(*BOX).alias("box")), "place").alias("o"))
    both = named.join(known, ["figure", "key"], "left").withColumn("m", F.struct(*BOX)).withColumn("ob", F.col("o.box"))
    apart = _apart("m", "ob")
    order = F.struct(apart.isNull(), F.coalesce(apart, -F.coalesce("confidence", F.lit(-1.0))), "detection_idx")
    return both.groupBy("figure", "key").agg(
        F.min("detection_idx").alias("place"), F.min_by("panel_label", "detection_idx").alias("first_label"), F.first("o").alias("o"),
        F.min_by(F.struct("detection_idx", "panel_caption", *BOX, "confidence"), order).alias("best"),
    )


def resolve(matches: DataFrame, originals: DataFrame) -> DataFrame:
    """(figure, place, panel_label, panel_caption, box, confidence, origin): the panels of each figure.

    matches: (figure, detection_idx, panel_label, panel_caption, x1..y2, confidence); originals:
    (figure, place, panel_label, panel_caption, x1..y2). Labels are compared without regard to
    case. Of several matches of one label the one whose centre is nearest to the known
    panel's box wins, else the surest, the first among equals; a panel takes the label and
    caption of the known one. A match with a blank label gets, in the order of detection, the
    first label that no panel before it has: A to Z, AA to ZZ, then unknown. Known panels
    without a match follow without a box. origin says matched, new, unlabelled or original.
    A null label counts as blank; a figure may occur on one side only.
    """
    blank = matches.where(F.coalesce(F.trim("panel_label") == "", F.lit(True)))
    named = _groups(matches, originals).select(
        "figure", F.col("place").cast("long"), F.coalesce("o.panel_label", "first_label").alias("panel_label"),
        F.when(F.col("o").isNotNull(), F.col("o.panel_caption")).otherwise(F.col("best.panel_caption")).alias("panel_caption"), *[F.col(f"best.{c}").alias(c) for c in [*BOX, "confidence"]],
        F.when(F.col("o").isNotNull(), "matched").otherwise("new").alias("origin"),
    )
    unnamed = blank.select("figure", F.col("detection_idx").cast("long").alias("place"), F.lit(None).cast("string").alias("panel_label"), "panel_caption", *BOX, "confidence", F.lit("unlabelled").alias("origin"))
    open_figures = unnamed.select("figure").distinct()
    # Only figures with a blank label pass Python: their rows stream by in order, with the set of
    # labels in use as all that is remembered.
    laid = named.join(open_figures, "figure", "left_semi").unionByName(unnamed).repartition("figure").sortWithinPartitions("figure", "place")
    labelled = laid.select(*[c.split()[0] for c in PANELS.split(", ")]).mapInPandas(_give_labels, PANELS)
    found = named.join(open_figures, "figure", "left_anti").unionByName(labelled)
    firsts = originals.withColumn("key", F.upper("panel_label")).groupBy("figure", "key").agg(F.min_by(F.struct("place", "panel_label", "panel_caption"), "place").alias("o"))
    left = firsts.join(found.select("figure", F.upper("panel_label").alias("key")).distinct(), ["figure", "key"], "left_anti")
    nothing = [F.lit(None).cast("double").alias(c) for c in [*BOX, "confidence"]]
    return found.unionByName(left.select("figure", (F.col("o.place") + 1_000_000).cast("long").alias("place"), "o.panel_label", "o.panel_caption", *nothing, F.lit("original").alias("origin")))


def conflicts(matches: DataFrame, originals: DataFrame) -> DataFrame:
    """(figure, panel_label, detection_idx, confidence): matches that lost their label to another."""
    won = _groups(matches, originals).select("figure", "key", F.coalesce("o.panel_label", "first_label").alias("label"), F.col("best.detection_idx").alias("winner"))
    named = matches.where(F.trim("panel_label") != "").select("figure", F.upper("panel_label").alias("key"), "detection_idx", "confidence")
    return named.join(won, ["figure", "key"]).where("detection_idx <> winner").select("figure", F.col("label").alias("panel_label"), "detection_idx", "confidence")


def _give_labels(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    figure, used, at = None, set(), 0
    for b in batches:
        labels = []
        for f, label in zip(b["figure"], b["panel_label"]):
            if f != figure:
                figure, used, at = f, set(), 0
            if label is None:
                while at < len(ALL_LABELS) and ALL_LABELS[at] in used:
                    at += 1  # labels are never given back
                label = ALL_LABELS[at] if at < len(ALL_LABELS) else "unknown"
            if label.upper() in _KNOWN:
                used.add(label.upper())
            labels.append(label)
        yield b.assign(panel_label=labels)


_KNOWN = frozenset(ALL_LABELS)
