"""Keyword-stuffed pages, link lists and tag lists.

A text is cut into blocks of whole lines and sentences. A block's compression ratio,
divided by the median ratio of all blocks of its language and length, says how redundant
it is; the share of its characters in real sentences is its sentence-punctuation evidence.
Lists of links and tags hardly repeat their letters but do repeat their make, so the same is
measured once more with each link, code and number replaced by one sign. A block is
stuffing if it is extremely redundant and short of sentences; the less redundant it is, the
fewer sentences it may have, and a block redundant only in its make must besides consist of
links and short items. A document is spam if stuffing makes up more than half of its length.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.operators.partitioning import spread
from folioforge.session import materialize

BLOCK = 600
#: (measure, its relative value under which, share of characters in sentences up to which, share
#: in links and short items from which) a block is stuffing; any one of the three is enough.
STUFFING = (("ratio", 0.80, 0.60, 0.0), ("ratio", 0.90, 0.45, 0.0), ("make", 0.80, 0.30, 0.6))
#: Words of a short item.
ITEM_WORDS = 6
#: The median of a language and length counts as so many blocks less than it has, those of all
#: languages of that length making up the difference.
SHRINKAGE = 50
#: Medians up to this number are sent to every task; there is one for each language and length.
MOST_MEDIANS = 50_000

# Function words of the corpus languages; a sentence has some of them.
FUNCTION_WORDS = frozenset(
    "a an and are as at be been between by for from had has have if in into is it its no not of on or over that the their them "
    "there they this to under was we were when which while with yet "
    "als am auf aus bei das dem den der des die ein eine einer eines für im ist mit nach nicht ob sich sind und unter von war wird wurde zu zum zur "
    "au aux avec cette chez dans de des du elle en est et il la le les leur même ne nous ou par pas pour que qui sans si son sont sur un une "
    "al aunque con de del el en entre es esta fue la las lo los más no para pero por que se sin su sus tras un una y".split()
)
_END = re.compile(r"[.!?…][\"')\]”’»]*(?=\s|$)")
_WORD = re.compile(r"[^\W_]+(?:['’-][^\W_]+)*")
_LINK = re.compile(r"(?:https?://|www\.)\S+")
_CODE = re.compile(r"[A-Z]{2,}\d*|\d[\d.,]*")
_STOP_END = re.compile(r"[.!?…][\"')\]”’»]*$")
_FACT = re.compile(r"[=<>;:%°μ(]|(?<![A-Za-z\d])\d")


def units(text: str) -> Iterator[str]:
    """Lines, and sentences within lines."""
    for line in re.split(r"[\r\n]+", text):
        a = 0
        for m in _END.finditer(line):
            if m.end() - a > 1:
                yield line[a : m.end()]
                a = m.end()
        if line[a:].strip():
            yield line[a:]


def is_sentence(unit: str) -> bool:
    """Whether a unit ends like a sentence and is built like one: words enough, among them
    function words, and no long run of short comma-parted items."""
    s = unit.strip()
    if not _STOP_END.search(s):
        return False
    words = _WORD.findall((_LINK.sub(" ", s) if _has_link(s) else s).lower())
    n = len(words)
    if n < 4 or s.count(",") > max(3, n // 8):
        return False
    return not FUNCTION_WORDS.isdisjoint(words) or bool(_FACT.search(s))


def make(block: str) -> str:
    """The block with one sign for each link and one for each code or number."""
    return _CODE.sub("0", _LINK.sub("@", block) if _has_link(block) else block)


_PARTS = re.compile(r"[\r\n•|;*\t]|,\s|(?<=\s)[-–/·>](?=\s)")


def _has_link(s: str) -> bool:
    return "://" in s or "www." in s


def itemised(block: str) -> int:
    """Characters in links and in short items parted by line ends, bullets, bars or commas."""
    n = 0
    for part in _PARTS.split(block):
        if _has_link(part):
            n += sum(map(len, _LINK.findall(part)))
            part = _LINK.sub(" ", part)
        part = part.strip()
        if part and len(part.split(None, ITEM_WORDS)) <= ITEM_WORDS and not _END.search(part):
            n += len(part)
    return n


def packed_size(raw: bytes) -> int:
    """Bytes of a block compressed; a window of 4 KB holds more than a block."""
    z = zlib.compressobj(6, zlib.DEFLATED, 12, 5)
    return len(z.compress(raw)) + len(z.flush())


def blocks(text: str, size: int = BLOCK) -> Iterator[tuple[str, int]]:
    """(block, characters in real sentences): whole units up to about `size` characters; an
    oversized unit is cut; a short last block joins the one before."""
    held: list[tuple[str, int]] = []
    part, n, real = [], 0, 0
    for u in units(text):
        ok = is_sentence(u)
        for k in range(0, len(u), size):
            piece = u[k : k + size]
            if n and n + len(piece) > size * 1.25:
                held.append(("\n".join(part), real))
                part, n, real = [], 0, 0
            part.append(piece)
            n += len(piece)
            real += len(piece) if ok else 0
    if n:
        if held and n < size // 2:
            last, r = held.pop()
            held.append((last + "\n" + "\n".join(part), r + real))
        else:
            held.append(("\n".join(part), real))
    yield from held


def bucket(n_bytes: int) -> int:
    return round(4 * math.log2(max(16, n_bytes)))


BLOCK_ROWS = "doc_id bigint, lang string, bucket int, chars long, sentence_chars long, item_chars long, ratio double, make double"


def _measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        rows = []
        for i, t, lang in zip(b["doc_id"], b["text"], b["lang"]):
            if not t:
                continue
            for block, real in blocks(t):
                raw = block.encode("utf-8", "replace")
                size = max(1, len(raw))
                rows.append((i, lang or "", bucket(len(raw)), len(block), real, itemised(block), packed_size(raw) / size, packed_size(make(block).encode("utf-8", "replace")) / size))
        yield pd.DataFrame(rows, columns=["doc_id", "lang", "bucket", "chars", "sentence_chars", "item_chars", "ratio", "make"])


def block_measures(df: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Every block with its ratios relative to blocks of its language and length.

    The reference value of a language and length is the geometric mean of its own median and
    that of all languages, weighted by its number of blocks against SHRINKAGE, so that few
    blocks weigh little and no number of blocks changes the rule.
    """
    rows = spread(df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang")))
    measured = materialize(rows.mapInPandas(_measure, BLOCK_ROWS))
    middle = lambda name: [F.percentile_approx(m, 0.5, 1000).alias(f"{name}_{m}") for m in ("ratio", "make")]
    own = measured.groupBy("lang", "bucket").agg(*middle("own"), F.count("*").alias("n"))
    every = measured.groupBy("bucket").agg(*middle("any"))
    weight = F.col("n") / (F.col("n") + SHRINKAGE)
    usual = [F.greatest(F.pow(f"own_{m}", weight) * F.pow(f"any_{m}", 1 - weight), F.lit(1e-6)).alias(f"usual_{m}") for m in ("ratio", "make")]
    medians = materialize(own.join(every, "bucket").select("lang", "bucket", *usual))
    if medians.limit(MOST_MEDIANS + 1).count() <= MOST_MEDIANS:
        medians = F.broadcast(medians)
    joined = measured.join(medians, ["lang", "bucket"])
    return joined.withColumns({f"relative_{m}": F.col(m) / F.col(f"usual_{m}") for m in ("ratio", "make")})


def find_spam(df: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """(doc_id, stuffed_share) of every document; null and empty texts have no row.

    Repeated documents each have their own row. A null language counts as a language.
    """
    stuffed = F.lit(False)
    for measure, below, sentences, items in STUFFING:
        stuffed = stuffed | ((F.col(f"relative_{measure}") < below) & (F.col("sentence_chars") <= sentences * F.col("chars")) & (F.col("item_chars") >= items * F.col("chars")))
    return block_measures(df, doc_id, text, lang).groupBy("doc_id").agg((F.sum(F.when(stuffed, F.col("chars")).otherwise(0)) / F.sum("chars")).alias("stuffed_share"))
