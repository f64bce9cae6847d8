"""One form for texts that look the same.

Compatibility normalisation in composed form, mapped whitespace and hyphens, removal of
default-ignorable characters, and one letter for letters that are drawn alike; computed
once per distinct value of each Arrow batch. Case folding is a parameter, off by default:
here case is visible. Raised and lowered characters, fractions and circled forms are
visible too, so compatibility mapping leaves them as they are.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.operators.partitioning import ROWS_PER_SALT, salt_count, spread
from folioforge.session import materialize

# Default-ignorable code points of the Unicode standard, as ranges.
IGNORABLE = (
    "\u00ad\u034f\u061c\u115f-\u1160\u17b4-\u17b5\u180b-\u180f\u200b-\u200f\u202a-\u202e\u2060-\u206f"
    "\u3164\ufe00-\ufe0f\ufeff\uffa0\ufff0-\ufff8\U0001bca0-\U0001bca3\U0001d173-\U0001d17a\U000e0000-\U000e0fff"
)
# Hyphens drawn like the ASCII one (dashes and the minus sign are longer).
HYPHENS = "\u2010\u2011\ufe63\uff0d"
# Letters of other scripts, and Latin variants, drawn like a Latin letter: those
# Cyrillic, Greek, Armenian and Cherokee entries of the Unicode confusables table that have the
# form of one Latin letter in common typefaces.
# Small Greek letters other than omicron are symbols of their own.
LOOK_ALIKES = {
    "A": "АΑᎪ", "B": "ВΒᏴ", "C": "СᏟϹ", "E": "ЕΕᎬ", "G": "Ԍ", "H": "НΗᎻ", "I": "ІΙӀ", "J": "ЈᎫ", "K": "КΚᏦ",
    "L": "Ꮮ", "M": "МΜᎷ", "N": "Ν", "O": "ОΟՕ", "P": "РΡᏢ", "Q": "Ԛ", "S": "ЅᏚՏ", "T": "ТΤᎢ", "V": "ѴᏙ",
    "W": "ԜᎳ", "X": "ХΧ", "Y": "ҮΥ", "Z": "ΖᏃ", "a": "аɑ", "c": "сϲ", "d": "ԁ", "e": "е", "g": "ɡ", "h": "һհ",
    "i": "і", "j": "јϳ", "l": "ӏ", "o": "оοօ", "p": "р", "q": "ԛ", "s": "ѕ", "u": "ս", "v": "ѵ", "w": "ԝ",
    "x": "х", "y": "уү",
}

_IGNORABLE = re.compile(f"[{IGNORABLE}]+")
_SPACE = re.compile(r"[^\S ]")
_HYPHEN = re.compile(f"[{HYPHENS}]")
_LATIN = str.maketrans({other: latin for latin, others in LOOK_ALIKES.items() for other in others})
#: Compatibility mappings of these kinds change what is seen.
_VISIBLE = ("<super>", "<sub>", "<fraction>", "<circle>")
_ASCII = re.compile(r"[\x20-\x7e]*\Z")


def _keep(c: str) -> bool:
    """Whether compatibility mapping would change what is seen of c."""
    kind = unicodedata.decomposition(c)
    return kind.startswith(_VISIBLE) or kind.startswith("<compat> 0020 ")


def _compatible(s: str) -> str:
    if unicodedata.is_normalized("NFKC", s):
        return s
    kept = {c for c in set(s) if ord(c) > 127 and _keep(c)}
    if not kept:
        return unicodedata.normalize("NFKC", s)
    parts = re.split("([" + re.escape("".join(sorted(kept))) + "])", s)
    return "".join(x if x in kept else unicodedata.normalize("NFKC", x) for x in parts)


def canonical(text: str, fold_case: bool = False) -> str:
    """The one form of a text; idempotent. Outer blanks are invisible and go."""
    s = text
    if not _ASCII.match(s):
        s = _SPACE.sub(" ", _IGNORABLE.sub("", s))
        s = _compatible(_HYPHEN.sub("-", s))
        bare = unicodedata.normalize("NFD", s)
        mapped = bare.translate(_LATIN)
        s = unicodedata.normalize("NFC", mapped)
    if fold_case:
        s = unicodedata.normalize("NFC", s.casefold())
    return s.strip(" ")


def canonical_column(text: Column, fold_case: bool = False) -> Column:
    """Null for null; each distinct value of a batch is brought to its form once."""

    @F.pandas_udf("string")
    def form(values: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in values:
            codes, distinct = pd.factorize(s)
            forms = pd.Series([canonical(x, fold_case) for x in distinct] + [None], dtype=object)
            yield forms.take(codes).reset_index(drop=True)  # code -1, null, takes the last

    return form(text)


def look_alike_pairs(df: DataFrame, group: str, id_col: str, text: str, rows_per_salt: int = ROWS_PER_SALT) -> DataFrame:
    """(group, id_a, id_b), id_a < id_b: texts of one group unequal as strings but equal in form.

    Nulls have no form and take part in no pair; empty texts look like blank ones. Repeated
    rows under different ids pair with each variant. Forms travel as 128-bit digests; only
    forms with two variants or more reach the join, and hot forms are salted there.
    """
    keyed = _forms(df, group, id_col, text)
    many = (
        keyed.groupBy("grp", "form").agg(F.min("raw").alias("lo"), F.max("raw").alias("hi"), F.count("*").alias("n"))
        .where("lo <> hi").select("grp", "form", salt_count(F.col("n"), rows_per_salt).alias("salts"))
    )
    hot = keyed.join(many, ["grp", "form"])
    a = hot.select("grp", "form", F.col("id").alias("id_a"), F.col("raw").alias("raw_a"), F.pmod(F.xxhash64("id"), "salts").cast("int").alias("salt"))
    b = hot.select("grp", "form", F.col("id").alias("id_b"), F.col("raw").alias("raw_b"), F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    pairs = a.join(b, ["grp", "form", "salt"]).where("id_a < id_b AND raw_a <> raw_b")
    return pairs.select(F.col("grp").alias(group), "id_a", "id_b")


def look_alike_classes(df: DataFrame, group: str, id_col: str, text: str) -> DataFrame:
    """(group, id, class_id, n_links): for each text its class of equal form, named after the least
    id, and the number of texts of the class that are made of other characters.

    As many rows as texts, whatever the size of a class: texts are counted by form and by
    form and characters, with map-side combining. Nulls have no form and no row.
    """
    keyed = _forms(df, group, id_col, text)
    same = keyed.groupBy("grp", "form", "raw").agg(F.count("*").alias("same"), F.min("id").alias("first"))
    alike = same.groupBy("grp", "form").agg(F.sum("same").alias("alike"), F.min("first").alias("class_id"))
    sized = same.select("grp", "form", "raw", "same").join(alike, ["grp", "form"])
    got = keyed.join(sized, ["grp", "form", "raw"])
    return got.select(F.col("grp").alias(group), "id", "class_id", (F.col("alike") - F.col("same")).alias("n_links"))


def _forms(df: DataFrame, group: str, id_col: str, text: str) -> DataFrame:
    """(grp, id, form, raw) with 128-bit digests of the one form and of the text itself."""
    rows = spread(df.where(F.col(text).isNotNull()).select(F.col(group).alias("grp"), F.col(id_col).alias("id"), F.col(text).alias("text")))
    return materialize(rows.select("grp", "id", F.unhex(F.md5(canonical_column(F.col("text")))).alias("form"), F.unhex(F.md5("text")).alias("raw")))
