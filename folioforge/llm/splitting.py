"""Oversized texts into overlapping pieces, cut at natural boundaries.

A text is a tree: sections by the rank of their headings, paragraphs, lines and list items by
their depth, sentences, clauses, words, characters. A node that fits is never opened; the
children of an oversized node that fit merge with their neighbours as long as those fit
together, the oversized ones are opened in their turn, and nothing merges across parents.
Bodies tile the text; each piece but the first starts with the stated number of characters
of the piece before it.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.operators.partitioning import spread

# Words whose full stop ends no sentence.
ABBREVIATIONS = "al approx ca cf cfr cont dr ed eds eq eqs etc e.g ex fig figs i.e incl inc ltd max min mr mrs ms no nos nr p pp prof ref refs resp sp spp st suppl tab v viz vol vs".split()

# Boundaries by level, the strongest first; a match ends where the next node starts.
_NEWLINE = r"(?:\r\n|\n|\r)"
LEVELS = (
    # a heading: numbered figure or table, Markdown or HTML heading, at the start of a line, block or sentence
    re.compile(rf"(?:{_NEWLINE}|</p>|<br\s*/?>|(?<=[.!?>]))[ \t]*(?:{_NEWLINE}[ \t]*){{0,8}}(?=(?:<(?:p|strong|b|em)>)*(?:(?:Supplementary |Extended Data )?(?:Figure|Fig\.|Table|Scheme|Box|Movie) ?\w{{1,4}}[.:]|\#{{1,6}} |<h[1-6]))", re.I),
    re.compile(rf"{_NEWLINE}[ \t]*(?:{_NEWLINE}[ \t]*)+|</(?:p|div|ul|ol|table|section|h[1-6])>\s*", re.I),
    re.compile(rf"{_NEWLINE}[ \t]*+(?![\r\n])|<br\s*/?>\s*|</(?:li|tr)>\s*|\s+(?=\([A-Z]\) |<strong>)", re.I),
    re.compile(r"(?<=[.!?])(?:[)\]\"'”’]|</\w+>)*\s+(?=[A-Z0-9(\[\"'“‘<]|[^\W\d_])"),
    re.compile(r"[;:,](?:</\w+>)*\s+"),
    re.compile(r"\s+"),
)
HEADING, LINE, SENTENCE, WORD = 0, 2, 3, 5
#: Rank of a heading without one of its own, such as a numbered figure.
NUMBERED = 7
_LONGEST = max(map(len, ABBREVIATIONS))
_LAST_WORD = re.compile(rf"(?:\A|[\s(\[<>])([^\s(\[<>]{{1,{_LONGEST}}})\.\Z")
_TAG = re.compile(r"<[^<>]+>|&#?\w+;")
_RANK = re.compile(r"(?:<(?:p|strong|b|em)>)*(?:(#{1,6}) |<h([1-6]))?", re.I)
_LIST = re.compile(r"<(/?)(?:ul|ol)\b", re.I)


class Tree:
    """The boundaries of one text, found level by level when a node needs them."""

    def __init__(self, text: str) -> None:
        self.text = text
        self.levels: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    @cached_property
    def tags(self) -> tuple[list[int], list[int]]:
        spans = [m.span() for m in _TAG.finditer(self.text)]
        return [a for a, _ in spans], [b for _, b in spans]

    def tag_around(self, at: int) -> int:
        """Where the tag or entity that stands on both sides of a place begins; -1 for none."""
        starts, ends = self.tags
        k = bisect_left(starts, at) - 1
        return starts[k] if k >= 0 and ends[k] > at else -1

    def _rank(self, level: int, m: re.Match, depth: int) -> int:
        """The smaller the rank, the nearer to the root: of a heading its own, of a line the depth
        of its list and of its indentation."""
        if level == HEADING:
            r = _RANK.match(self.text, m.end())
            return len(r[1]) if r[1] else int(r[2]) if r[2] else NUMBERED
        if level == LINE:
            indent = m[0].rsplit("\n", 1)[-1].rsplit("\r", 1)[-1].expandtabs(4) if m[0][:1] in "\r\n" else ""
            return depth * 1_000_000 + min(len(indent), 999_999)
        return 0

    def boundaries(self, level: int) -> tuple[np.ndarray, np.ndarray]:
        """(places where a node of the level begins, their ranks)."""
        if level not in self.levels:
            found, ranks, depth = [], [], 0
            lists = [(m.start(), -1 if m[1] else 1) for m in _LIST.finditer(self.text)] if level == LINE else []
            passed = 0
            for m in LEVELS[level].finditer(self.text):
                while passed < len(lists) and lists[passed][0] < m.start():
                    depth += lists[passed][1]
                    passed += 1
                if level == SENTENCE:
                    w = _LAST_WORD.search(self.text[max(0, m.start() - _LONGEST - 2) : m.start()])
                    if w and (w[1].lower() in ABBREVIATIONS or len(w[1]) == 1 and w[1].isupper()):
                        continue
                if level == WORD and self.tag_around(m.end()) >= 0:
                    continue
                found.append(m.end())
                ranks.append(self._rank(level, m, max(0, depth)))
            self.levels[level] = np.array(found, np.int64), np.array(ranks, np.int64)
        return self.levels[level]

    def children(self, a: int, b: int, level: int) -> list[int]:
        """Places strictly inside [a, b) where its children of the level begin."""
        places, ranks = self.boundaries(level)
        lo, hi = bisect_right(places, a), bisect_left(places, b)
        if lo >= hi:
            return []
        return places[lo:hi][ranks[lo:hi] == ranks[lo:hi].min()].tolist()

    def hard_cuts(self, a: int, b: int, size: int) -> list[int]:
        """Cuts where nothing natural is left: between characters as they are seen, if possible."""
        text, found = self.text, []
        while b - a > size:
            e = a + size
            low = max(a + size // 2, a + 1)
            k = e
            while k > low and (unicodedata.combining(text[k]) or text[k] in "\u200d\ufe0e\ufe0f" or text[k - 1] == "\u200d" or text[k - 1 : k + 1] == "\r\n"):
                k -= 1
            tag = self.tag_around(k)
            if tag > low:
                k = tag
            a = k if k > low else e
            found.append(a)
        return found


def bodies(text: str, size: int) -> list[tuple[int, int]]:
    """Spans of at most `size` characters that tile the text."""
    tree, out = Tree(text), []
    todo = [(0, len(text), HEADING)]
    while todo:
        a, b, level = todo.pop()
        if b - a <= size:
            out.append((a, b))
            continue
        if level == len(LEVELS):
            edges = [a, *tree.hard_cuts(a, b, size), b]
            out.extend(zip(edges, edges[1:]))
            continue
        inner = tree.children(a, b, level)
        if not inner:
            todo.append((a, b, level + 1))
            continue
        merged: list[tuple[int, int]] = []
        for x, y in zip([a, *inner], [*inner, b]):
            if merged and y - merged[-1][0] <= size:  # both fit, and together
                merged[-1] = (merged[-1][0], y)
            else:
                merged.append((x, y))
        todo.extend((x, y, level) for x, y in reversed(merged))
    return out


def pieces(text: str, max_size: int, overlap: int) -> list[tuple[int, int, int]]:
    """(body start, start, end): piece k is text[start:end], at most max_size characters, and
    repeats the last `overlap` characters before its body."""
    if not 0 <= overlap < max_size:
        raise ValueError("the overlap must be smaller than the size limit")
    if len(text) <= max_size:
        return [(0, 0, len(text))]
    return [(a, max(0, a - overlap), b) for a, b in bodies(text, max_size - overlap)]


PIECES = "section_id bigint, field_name string, piece_no int, body_start int, start int, end int, piece string"


def split_fields(df: DataFrame, limits: DataFrame, id_col: str, fields: list[str], oversized_only: bool = False) -> DataFrame:
    """Ordered pieces of each field: positions count code points from 0, the end exclusive.

    Null fields give no piece; an empty text or one within the limit is one piece, as it
    stands; repeated rows are split each. A field without a row in the limits is not split;
    with several, the smallest limit holds. Lengths are compared before Python sees a row.
    """
    out = None
    known = {r["limit_name"]: r for r in limits.where(F.col("limit_name").isin(fields)).groupBy("limit_name").agg(F.min("max_size").alias("max_size"), F.min("overlap_size").alias("overlap_size")).collect()}  # at most one row a field
    for f in fields:
        rows = df.where(F.col(f).isNotNull()).select(F.col(id_col).alias("section_id"), F.lit(f).alias("field_name"), F.col(f).alias("piece"))
        n = F.char_length("piece")
        most, overlap = (known[f]["max_size"], known[f]["overlap_size"] or 0) if f in known else (2**31 - 1, 0)
        whole = rows.where(n <= most).select("section_id", "field_name", F.lit(1).alias("piece_no"), F.lit(0).alias("body_start"), F.lit(0).alias("start"), n.alias("end"), "piece")
        cut = spread(rows.where(n > most)).mapInPandas(_splitter(most, overlap), PIECES)
        part = cut if oversized_only else whole.unionByName(cut)
        out = part if out is None else out.unionByName(part)
    return out


def _splitter(most: int, overlap: int):
    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [
                (i, f, k, body, start, end, text[start:end])
                for i, f, text in zip(b["section_id"], b["field_name"], b["piece"])
                for k, (body, start, end) in enumerate(pieces(text, most, overlap), 1)
            ]
            yield pd.DataFrame(rows, columns=["section_id", "field_name", "piece_no", "body_start", "start", "end", "piece"])

    return split
