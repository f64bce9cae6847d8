"""Evaluation passages inside a corpus, by spaced seeds.

A seed is a hash of the words at the set positions of a fixed mask; positions that the mask
ignores may differ. Every window of every passage and of every document gives one seed for
each mask; equal seeds are hits, and around each hit the words are compared along the
diagonal: exactly, for the longest run of equal words, and with substitutions allowed, for
the longest overlap. Runs are searched by masks that span no more words than the shortest
run asked for, so every such run holds a seed and none can be missed. Overlaps are searched
by six lighter masks: of all ways to substitute one word in five of ten to sixteen words, at
most one in five hundred has no seed (counted in the tests).

Few passages travel to every task. For many, the seeds of the corpus that no passage has are
dropped by a bitmap of bounded size, the others meet those of the passages in a shuffle with
hot seeds dealt out, and only texts with a hit are moved to be compared.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.operators.linkage import meet
from folioforge.operators.partitioning import spread
from folioforge.session import materialize

#: 1: the word counts, 0: any word may stand there. Each spans ten words.
MASKS = ("1110110111", "1011011101")
RUN = len(MASKS[0])
#: Masks for overlaps of RUN words and more with substitutions.
OVERLAP_MASKS = ("1110111", "110100111", "1111101", "1000011111", "1101010011", "110011011")
#: Passages with up to so many seeds travel to every task (16 bytes a seed); more are joined by a shuffle.
MOST_SEEDS = 2_000_000
#: One word in so many of an overlap may be substituted.
ONE_IN = 5
#: Bits of the bitmap by which seeds and documents without a hit are dropped (16 MB).
BITS = 1 << 27
#: Passages that are compared with one document at a time.
PASSAGES_PER_ROW = 200

_TAG = re.compile(r"<!--.*?-->|</?[a-zA-Z][^<>]*>", re.S)
_DIVIDED = re.compile(r"(?<=[^\W\d_])[-\u00ad\u2010]\s*[\r\n]\s*(?=[^\W\d_])")
_WORD = re.compile(r"[^\W_]+")
_HIDDEN = re.compile("[\u00ad\u200b-\u200f\u2060\ufeff]")
#: Marks inside a word: a tag of running text with a letter or digit on both sides.
_INSIDE = re.compile(r"(?<=\w)</?(?:a|abbr|b|em|font|i|mark|small|span|strong|sub|sup|u)\b[^<>]*>(?=\w)", re.I)


def word_lists(text: str | None) -> list[list[str]]:
    """The words of a text, in lower case, without markup: once more for each way in which
    words may be divided, by a hyphen at a line end or by a tag inside a word."""
    if not text:
        return []
    forms = [text]
    if "<" in text:
        bare = _TAG.sub(" ", text)
        inside = _TAG.sub(" ", _INSIDE.sub("", text))
        forms = [bare] if inside == bare else [bare, inside]
    if "&" in text:
        forms = [html.unescape(f) for f in forms]
    if "\n" in text or "\r" in text:
        forms = list(dict.fromkeys(g for f in forms for g in (_DIVIDED.sub("", f), f)))
    return [_WORD.findall((f if f.isascii() else _HIDDEN.sub("", f)).lower()) for f in forms]


_known: dict[str, int] = {}
#: Words that a process remembers the ids of.
KNOWN_MOST = 1_000_000


def word_ids(words: list[str]) -> np.ndarray:
    """A 64-bit id of each word, the same in every process."""
    try:
        return np.fromiter(map(_known.__getitem__, words), np.uint64, len(words))
    except KeyError:
        if len(_known) > KNOWN_MOST:
            _known.clear()
        fresh = [w for w in dict.fromkeys(words) if w not in _known]
        _known.update(zip(fresh, pd.util.hash_array(np.array(fresh, dtype=object), categorize=False).tolist()))
        return np.fromiter(map(_known.__getitem__, words), np.uint64, len(words))


def _odd(n: int) -> np.ndarray:
    rng = np.random.Generator(np.random.PCG64(20_240_229))
    return rng.integers(1, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


_FACTORS = _odd(64)


def seeds(ids: np.ndarray, mask: str) -> np.ndarray:
    """One seed for each window of the mask's span; empty if there are fewer words."""
    n = len(ids) - len(mask) + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.full(n, np.uint64(len(mask) + int(mask, 2)), np.uint64)
    for k, bit in enumerate(mask):
        if bit == "1":
            x = ids[k : k + n] * _FACTORS[k]
            out += x ^ (x >> np.uint64(29))
    return out


class Passages:
    """The passages' words and seeds, ready to be met by documents."""

    def __init__(self, items: list[tuple[int, str]], masks: tuple[str, ...] = MASKS) -> None:
        self.masks = masks
        self.ids: list[tuple[int, np.ndarray]] = [(i, word_ids(w)) for i, text in items for w in word_lists(text)]
        self.tables = []
        for m in masks:
            parts = [(seeds(x, m), k) for k, (_, x) in enumerate(self.ids)]
            h = np.concatenate([s for s, _ in parts]) if parts else np.empty(0, np.uint64)
            item = np.concatenate([np.full(len(s), k, np.int32) for s, k in parts]) if parts else np.empty(0, np.int32)
            at = np.concatenate([np.arange(len(s), dtype=np.int32) for s, _ in parts]) if parts else np.empty(0, np.int32)
            order = np.argsort(h, kind="stable")
            low = np.uint64((1 << min(20, max(6, (8 * len(h)).bit_length()))) - 1)
            bloom = np.zeros(int(low) + 1, bool)
            bloom[(h & low).astype(np.int64)] = True
            self.tables.append((h[order], item[order], at[order], bloom, low))

    def overlaps(self, ids: np.ndarray, run: int = RUN) -> dict[int, tuple[int, int, int]]:
        """item -> (longest run of equal words, words of the best overlap, unequal ones in it)."""
        found: dict[int, tuple[int, int, int]] = {}
        met: set[tuple[int, int]] = set()
        for mask, (h, item, at, bloom, low) in zip(self.masks, self.tables):
            s = seeds(ids, mask)
            if not len(s) or not len(h):
                continue
            where = np.flatnonzero(bloom[(s & low).astype(np.int64)])
            if not len(where):
                continue
            lo, hi = np.searchsorted(h, s[where], "left"), np.searchsorted(h, s[where], "right")
            for p, a, b in zip(where[hi > lo], lo[hi > lo], hi[hi > lo]):
                for k in range(a, b):
                    key = (int(item[k]), int(p) - int(at[k]))
                    if key in met:
                        continue
                    met.add(key)  # the whole diagonal is compared at once
                    name, words = self.ids[key[0]]
                    got = compare(ids, words, key[1])
                    old = found.get(name, (0, 0, 0))
                    found[name] = better(old, got)
        return found


def better(a: tuple[int, int, int], b: tuple[int, int, int]) -> tuple[int, int, int]:
    """The longer run and, whichever of the two has it, the overlap of more equal words."""
    return (max(a[0], b[0]), *max(a[1:], b[1:], key=lambda x: (x[0] - x[1], -x[1])))


def compare(ids: np.ndarray, words: np.ndarray, shift: int) -> tuple[int, int, int]:
    """Along one diagonal: longest run of equal words; length and unequal words of the longest
    stretch, equal at both ends, of which at most one word in ONE_IN is unequal."""
    a, b = max(0, shift), min(len(ids), shift + len(words))
    equal = ids[a:b] == words[a - shift : b - shift]
    edges = np.flatnonzero(np.diff(np.concatenate([[False], equal, [False]])))
    if not len(edges):
        return 0, 0, 0
    starts, ends = edges[::2], edges[1::2]  # runs of equal words
    # A stretch from run i to run j holds as many unequal words as stand between them.
    n_before = np.concatenate([[0], np.cumsum(ends - starts)])
    credit_start = starts - ONE_IN * (starts - n_before[:-1])  # of a stretch: length less ONE_IN for each unequal word
    credit_end = ends - ONE_IN * (ends - n_before[1:])
    # The longest pair i <= j with credit_end[j] >= credit_start[i]: starts that no earlier one undercuts suffice.
    lowest = np.minimum.accumulate(credit_start)
    first = np.searchsorted(-lowest, -credit_end, "left")
    first = np.minimum(first, np.arange(len(ends)))
    lengths = ends - starts[first]
    j = int(lengths.argmax())
    n = int(lengths[j])
    return int((ends - starts).max()), n, n - int(n_before[j + 1] - n_before[first[j]])


FOUND = "doc_id bigint, item_id bigint, longest_run int, overlap_words int, substituted int"


def find_leaks(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", passage: str = "passage", most_seeds: int = MOST_SEEDS, masks: tuple[str, ...] = MASKS) -> DataFrame:
    """Every (document, item) with a hit: longest run of equal words, best overlap, substitutions.

    MASKS find every run of RUN equal words, OVERLAP_MASKS overlaps of RUN words as well.
    Null, empty and short texts (fewer words than a mask spans) have no seed and no row.
    Repeated documents and items each give their own rows. Words are runs of letters or
    digits; letter case, punctuation, markup, line breaks and division at a line end make
    no difference.
    """
    corpus = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    asked = items.where(F.col(passage).isNotNull()).select(F.col(item_id).alias("item_id"), F.col(passage).alias("passage"))
    # A passage has a seed for each word and mask, for each way to divide words.
    n_words = asked.agg(F.sum(F.regexp_count("passage", F.lit(r"[\p{L}\p{N}]+")))).first()[0] or 0
    if n_words * 4 * len(masks) <= most_seeds:
        listed = [tuple(r) for r in asked.collect()]
        return spread(corpus).mapInPandas(_meet(listed, masks), FOUND)
    return _joined(corpus, asked, masks)


def _meet(listed: list[tuple[int, str]], masks: tuple[str, ...]):
    def meet(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        passages = Passages(listed, masks)
        for b in batches:
            rows = []
            for i, t in zip(b["doc_id"], b["text"]):
                rows.extend(_found(i, t, passages))
            yield pd.DataFrame(rows, columns=["doc_id", "item_id", "longest_run", "overlap_words", "substituted"])

    return meet


def _seed_rows(id_col: str, text: str, masks: tuple[str, ...], known: Broadcast | None = None):
    """The distinct seeds of each text; with a bitmap, only those that it has."""
    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for i, t in zip(b[id_col], b[text]):
                parts = [seeds(word_ids(w), m) for w in word_lists(t) for m in masks]
                own = np.unique(np.concatenate(parts)) if parts else np.empty(0, np.uint64)
                own = own if known is None else own[_has(known.value, own)]
                if len(own):
                    yield pd.DataFrame({"seed": own.view(np.int64), id_col: i})

    return emit


def _has(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    at = (values & np.uint64(BITS - 1)).astype(np.int64)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def _bitmap(df: DataFrame, value: Column) -> Broadcast:
    """A bit for each value's low bits, put together from bitmaps of 4 KB: BITS / 8 bytes at most."""
    x = F.pmod(value, F.lit(BITS)) + 1
    parts = df.groupBy(F.bitmap_bucket_number(x).alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(x)).alias("bits")).collect()
    bits = np.zeros(BITS // 8, np.uint8)
    for k, part in parts:
        bits[(k - 1) * 4096 : k * 4096] = np.frombuffer(part, np.uint8)
    return df.sparkSession.sparkContext.broadcast(bits)


def _joined(corpus: DataFrame, asked: DataFrame, masks: tuple[str, ...]) -> DataFrame:
    """The same for a list of passages that no task should hold: seeds meet in a shuffle, then
    each document with a hit is compared with the passages that share a seed with it."""
    b = materialize(spread(asked).mapInPandas(_seed_rows("item_id", "passage", masks), "seed bigint, item_id bigint"))
    known = _bitmap(b, F.col("seed"))
    a = materialize(spread(corpus).mapInPandas(_seed_rows("doc_id", "text", masks, known), "seed bigint, doc_id bigint"))
    pairs = materialize(meet(a, b, "seed", "doc_id", "item_id").select("doc_id", "item_id").distinct())
    hit = _bitmap(pairs, F.xxhash64("doc_id"))

    def marked(hashes: pd.Series) -> pd.Series:
        return pd.Series(_has(hit.value, hashes.to_numpy(np.int64).view(np.uint64)))

    texts = corpus.where(F.pandas_udf(marked, "boolean")(F.xxhash64("doc_id")))
    # A document with many passages is compared with a bounded number of them at a time.
    sizes = pairs.groupBy("doc_id").agg(F.ceil(F.count("*") / PASSAGES_PER_ROW).cast("long").alias("parts"))
    parted = pairs.join(sizes, "doc_id").withColumn("part", F.pmod(F.xxhash64("item_id"), "parts")).join(asked, "item_id")
    listed = parted.groupBy("doc_id", "part").agg(F.collect_list(F.struct("item_id", "passage")).alias("listed"))

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            rows = []
            for i, t, items in zip(x["doc_id"], x["text"], x["listed"]):
                rows.extend(_found(i, t, Passages([(r["item_id"], r["passage"]) for r in items], masks)))
            yield pd.DataFrame(rows, columns=["doc_id", "item_id", "longest_run", "overlap_words", "substituted"])

    return listed.join(texts, "doc_id").select("doc_id", "text", "listed").mapInPandas(check, FOUND)


def _found(doc_id: int, text: str, passages: Passages) -> list[tuple]:
    best: dict[int, tuple[int, int, int]] = {}
    for w in word_lists(text):
        for k, v in passages.overlaps(word_ids(w)).items():
            best[k] = better(best.get(k, v), v)
    return [(doc_id, k, *v) for k, v in best.items()]
