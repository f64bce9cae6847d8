"""Functions that SQL can call by name, once registered with a session."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from folioforge.functions import sequence, text

# What is said of an extract.
VERBATIM, NOT_VERBATIM, EMPTY = "The extraction is verbatim", "The extraction is NOT verbatim", "One or both texts are empty"


def verbatim_form(s: str) -> str:
    """What text.normalize_verbatim gives, for one text."""
    kept = "".join(c for c in text.decomposed(s) if c.isalnum() or c.isspace())
    return " ".join(kept.split())


def _run_of(labels: list[str]) -> tuple[list[str] | None, bool, str]:
    """The run that the labels span, whether they are it, and what a foreign label is called."""
    first = labels[0]
    if first in sequence.FIRST_ROMANS:
        foreign = next((x for x in labels if not re.match(sequence.ROMAN, x, re.I)), None)
        if foreign is not None:
            return None, False, sequence.FOREIGN_ROMAN + foreign
        places = [_numerals()[x.upper()] for x in labels]
        names = list(_numerals())
        run = names[min(places) - 1 : max(places)]
        return run, len(set(places)) == len(run), ""
    for alphabet in (sequence.LETTERS, sequence.LETTERS.lower()):
        if first in alphabet:
            a, b = alphabet.find(first), alphabet.find(labels[-1])
            run = list(alphabet[a : b + 1]) if b >= 0 else None
            return run, run == labels, sequence.FOREIGN_LETTER
    if re.fullmatch("[0-9]+", first):
        if not all(re.fullmatch(r"[+-]?[0-9]{1,9}", x) for x in labels):
            return None, False, sequence.FOREIGN_NUMBER
        values = [int(x) for x in labels]
        run = list(range(values[0], values[-1] + 1))
        return [str(k) for k in run], values == run, ""
    return None, False, sequence.UNKNOWN_KIND


_known_numerals: dict[str, int] = {}


def _numerals() -> dict[str, int]:
    """All Roman numerals in order, with their values."""
    if not _known_numerals:
        place = [["", *(x.translate(str.maketrans("IVX", y)) for x in ("I", "II", "III", "IV", "V", "VI", "VII", "VIII", "IX"))] for y in ("IVX", "XLC", "CDM")]
        for n in range(1, 5000):
            _known_numerals["M" * (n // 1000) + place[2][n // 100 % 10] + place[1][n // 10 % 10] + place[0][n % 10]] = n
    return _known_numerals


def sequence_verdict(labels: list[str] | None) -> dict:
    """What sequence.verify gives for labels as they are typed, for one list."""
    if labels is None or not len(labels):
        return {"is_valid": False, "fixed_sequence": [], "details": sequence.NO_LABELS}
    bare = [re.sub(r"[().\s]", "", x or "") for x in labels]
    run, same, foreign = _run_of(bare)
    details = sequence.VALID if same else foreign if run is None else sequence.GAPS + ", ".join(run)
    return {"is_valid": same, "fixed_sequence": bare if run is None else run, "details": details}


def register(spark: SparkSession) -> None:
    """verify_caption_extraction(extracted, original) and verify_panel_sequence(labels), each a
    struct; nothing is verbatim if either text is null or empty, and a null or empty list is not valid."""

    @F.pandas_udf("is_verbatim boolean, details string")
    def caption(extracted: pd.Series, original: pd.Series) -> pd.DataFrame:
        hits = [bool(a and b) and verbatim_form(a) in verbatim_form(b) for a, b in zip(extracted, original)]
        return pd.DataFrame({"is_verbatim": hits, "details": [VERBATIM if h else NOT_VERBATIM if a and b else EMPTY for h, a, b in zip(hits, extracted, original)]})

    @F.pandas_udf("is_valid boolean, fixed_sequence array<string>, details string")
    def panels(labels: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([sequence_verdict(x) for x in labels], columns=["is_valid", "fixed_sequence", "details"])

    spark.udf.register("verify_caption_extraction", caption)
    spark.udf.register("verify_panel_sequence", panels)
