"""Text functions as Column expressions; all run inside the JVM unless said otherwise.

Null in, null out; an empty text stays empty.
"""

from __future__ import annotations

import html
import re
import string
import unicodedata
from collections.abc import Callable
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Marks of expanded-view figures.
EXPANDED_VIEW = r"(?i)ev|extended view|expanded view|extended data"
# Names that archives hold beside the data.
SYSTEM_FILES = ("Thumbs.db", "desktop.ini", ".DS_Store")


# What is no text in HTML: comments, scripts and styles with all they hold, and tags. Both
# regular-expression engines, the JVM's and Python's, read these alike. A less-than sign before
# anything but a letter or slash is text.
HIDDEN = r"<!--[\s\S]*?-->|<script[\s\S]*?</script>|<style[\s\S]*?</style>|</?[A-Za-z][^>]*>"
#: Control and format characters but line breaks.
CONTROL = r"[\p{Cc}\p{Cf}&&[^\n\r]]"
SPACE = r"(?U)\s"
_hidden = re.compile(HIDDEN)


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """An expression that uses a value several times but has it computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _where(text: Column, condition: Callable[[Column], Column], change: Callable[[str], str], otherwise: Callable[[Column], Column]) -> Column:
    """`change` in Python for texts that meet the condition, in Arrow batches that hold only
    those; the JVM's expression for all others."""

    @F.pandas_udf("string")
    def changed(s: pd.Series) -> pd.Series:
        return s.map(lambda x: None if x is None else change(x))

    return F.coalesce(changed(_let(text, lambda t: F.when(condition(t), t))), _let(text, otherwise))


def _visible(s: str, gap: str) -> str:
    """What strip_tags gives, with entities resolved."""
    parts = [html.unescape(x) for x in _hidden.split(s)]
    return gap.join(x for x in map(str.strip, parts) if x) if gap else "".join(parts)


def _visible_if_tagged(s: str) -> str:
    return _visible(s, " ") if "<" in s and ">" in s else s


def strip_tags(text: Column, gap: str = " ") -> Column:
    """Text without comments, scripts, styles and tags, entities resolved.

    With a gap, the stretches of text are trimmed and joined by it, and a text without any
    angle brackets is left as it is; without one, the stretches are joined as they stand.
    """
    if gap:
        return _where(text, lambda t: _tagged(t) & t.contains("&"), lambda s: _visible(s, gap), lambda t: _stretches(t, gap))
    return _where(text, lambda t: t.contains("&"), lambda s: _visible(s, ""), lambda t: F.array_join(F.split(t, HIDDEN), ""))


def _tagged(text: Column) -> Column:
    return text.contains("<") & text.contains(">")


def _stretches(text: Column, gap: str = " ") -> Column:
    joined = F.array_join(F.filter(F.transform(F.split(text, HIDDEN), _trim), lambda x: x != ""), gap)
    return F.when(_tagged(text), joined).otherwise(text)


def _trim(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def collapse(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, SPACE + "+", " "))


def unescape(text: Column) -> Column:
    """All entities of HTML, named and numbered."""
    return _where(text, lambda t: t.contains("&"), html.unescape, lambda t: t)


def drop_empty_items(text: Column) -> Column:
    """List items that hold nothing but blanks, no-break spaces and line breaks go."""
    return F.regexp_replace(text, "(?i)<li>(?:\\s|&nbsp;|\u00a0|<br\\s*/?>)*</li>", "")


def normalize(text: Column, control: bool = True, lower: bool = True, markup: bool = True, punctuation: bool = False, keep: str = "", ascii_only: bool = False) -> Column:
    """A text for comparison, step by step: control and format characters away, lower case,
    entities resolved and tags to blanks, punctuation (but the signs to keep) to blanks, other
    than ASCII characters decomposed or dropped; whitespace always collapsed."""
    s = F.regexp_replace(text, CONTROL, "") if control else text
    s = F.lower(_trim(s)) if lower else _trim(s)
    if markup:
        # an entity may resolve to a tag, so both steps are taken in one place
        s = _where(s, lambda t: t.contains("&"), lambda x: _visible_if_tagged(html.unescape(x)), lambda t: _stretches(t))
    if punctuation:
        signs = "".join(c for c in string.punctuation if c not in keep)
        s = F.regexp_replace(s, "[" + "".join("\\" + c for c in signs) + "]", " ") if signs else s
    return collapse(ascii_fold(s) if ascii_only else s)


def normalize_basic(text: Column) -> Column:
    """Control characters away, lower case, entities resolved, tags to blanks, whitespace collapsed."""
    return normalize(text)


def decomposed(s: str) -> str:
    return unicodedata.normalize("NFKD", html.unescape(_visible(s, "")).lower())


def normalize_verbatim(text: Column) -> Column:
    """Tags away without a gap, entities resolved, lower case, compatibility decomposition, only
    letters, digits and blanks. Spark has no decomposition, so texts with other than ASCII
    characters or entities pass Python."""
    other = lambda t: t.rlike(r"[^\x00-\x7f&]|&")
    s = _where(text, other, decomposed, lambda t: F.lower(F.array_join(F.split(t, HIDDEN), "")))
    return collapse(F.regexp_replace(s, r"(?U)[^\p{L}\p{N}\s]", ""))


def normalize_scored(text: Column, squeeze: bool = False, availability: bool = False) -> Column:
    """The form in which outputs are scored: entities resolved, then all in angle brackets away;
    a heading of the availability section and repeated whitespace on request."""
    s = F.regexp_replace(text, r"(?i)^data\s+availability\s*[:.]?\s*", "") if availability else text
    s = F.regexp_replace(unescape(s), "<[^>]+>", "")
    return collapse(s) if squeeze else s


def ascii_fold(text: Column) -> Column:
    """Compatibility decomposition with all that is not ASCII dropped."""
    return _where(text, lambda t: t.rlike(r"[^\x00-\x7f]"), lambda x: unicodedata.normalize("NFKD", x).encode("ascii", "ignore").decode(), lambda t: t)


def excerpt(text: Column, most: int = 160) -> Column:
    s = collapse(text)
    return F.when(F.char_length(s) > most, F.concat(F.substring(s, 1, most), F.lit("..."))).otherwise(s)


def clean_path(path: Column, own_id: Column | None = None) -> Column:
    """The path without its first part, if that is the id or has both a hyphen and a digit."""
    parts = F.split(F.replace(path, F.lit("\\"), F.lit("/")), "/")
    head = F.element_at(parts, 1)
    drop = head.contains("-") & head.rlike("[0-9]")
    if own_id is not None:
        drop = drop | (head == own_id)
    return F.when(drop & (F.size(parts) > 1), F.array_join(F.slice(parts, F.lit(2), F.size(parts) - 1), "/")).otherwise(F.array_join(parts, "/"))


def figure_label(label: Column) -> Column:
    """Figure and all digits of the label; the label itself if it has none."""
    digits = F.regexp_replace(label, "[^0-9]", "")
    return F.when(digits != "", F.concat(F.lit("Figure "), digits)).otherwise(label)


def panel_label(label: Column) -> Column:
    """The letter that ends the label, digits after it left out; else the label in upper case."""
    up = F.upper(label)
    return F.coalesce(F.nullif(F.regexp_extract(up, r"([A-Z])[0-9]*$", 1), F.lit("")), up)


def file_name(name: Column) -> Column:
    """A name fit for a file: blanks and slashes to underscores, other signs away, lower case."""
    return F.lower(F.regexp_replace(F.translate(name, " /\\", "___"), "[^A-Za-z0-9._-]", ""))


# Signs that archives garble in file names.
GARBLED = {"ª┬": "β", "í≈": "△"}


def repair_name(name: Column) -> Column:
    """A file name with its garbled signs put right."""
    return reduce(lambda s, e: F.replace(s, F.lit(e[0]), F.lit(e[1])), GARBLED.items(), name)


def is_data_member(member: Column) -> Column:
    """Whether an archive member is data: no directory, no system or hidden file."""
    system = reduce(lambda a, b: a | b, (member.contains(s) for s in SYSTEM_FILES))
    return ~(member.endswith("/") | member.contains("__MACOSX") | system | member.startswith("."))


def fill_template(template: str, values: dict[str, Column]) -> Column:
    """$name replaced by its value, longer names first; unknown names stay."""
    s = F.lit(template)
    for name in sorted(values, key=len, reverse=True):
        s = F.replace(s, F.lit("$" + name), F.coalesce(values[name].cast("string"), F.lit("")))
    return s


def tokens(text: Column) -> Column:
    """Tokens by the rule of four characters each."""
    return F.floor(F.char_length(text) / 4).cast("bigint")


def data_url_parts(url: Column) -> Column:
    """struct(mime, payload) of a base64 data URL; null for any other text."""
    p = r"^data:([^;,]+);base64,(.*)$"
    return F.when(url.rlike(p), F.struct(F.regexp_extract(url, p, 1).alias("mime"), F.regexp_extract(url, p, 2).alias("payload")))


def json_in_reply(reply: Column, opening: str = "{", closing: str = "}") -> Column:
    """The JSON text of a model's reply: a fenced block, else from the first opening to the last
    closing bracket, line breaks and tabs to blanks; null if there is neither."""
    fenced = F.nullif(F.regexp_extract(reply, r"(?s)```(?:json)?\s*(.*?)```", 1), F.lit(""))
    bare = F.nullif(F.regexp_extract(reply, rf"(?s)(\{opening}.*\{closing})", 1), F.lit(""))
    return F.trim(F.regexp_replace(F.coalesce(fenced, bare), r"[\n\r\t]", " "))
