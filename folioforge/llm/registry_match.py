"""Freely typed names to the entries of a canonical list, by a BK-tree.

Every entry stands in the tree under the spellings people use for it: its name, the name
turned around (rotations of its words), leading parts of the name, and, to be met exactly,
its short code, initials and host. Distances are Damerau-Levenshtein distances of the letters and
digits alone, a true metric, so the triangle inequality prunes the tree and a search
returns every entry within the threshold. A second tree has the words of the names, their
beginnings and their consonants; by it abbreviations are laid over the words of a name. A
value is searched as it stands, without wrapping words ("deposited in the ... database"),
inside and outside brackets, and word by word.

Only distinct values are searched. A list too long for one task is searched shard by shard,
and what fits best of all shards counts. Entries that fit alike are told apart after that,
by the accession number, then by the host of the URL.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache, reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.llm.normalize import canonical
from folioforge.session import materialize

#: The threshold of a search: one edit for each so many letters and digits, at most MOST_EDITS.
LETTERS_PER_EDIT, MOST_EDITS = 5, 3
#: A leading part of a name is less to go by: one edit, from so many letters on.
LETTERS_PER_PART_EDIT = 8
#: A list up to this size travels to every task as one tree; a longer one is searched shard by shard.
ENTRIES_PER_SHARD = 20_000
#: Distinct values that one task of a sharded search holds.
VALUES_PER_BLOCK = 100_000

# Words that wrap a name without naming anything.
WRAPPERS = frozenset(
    "a an and at available by data database databank dataset datasets db deposit deposited deposition entry entries "
    "from here hosted id ids in into its main of on our page portal project public record records release released "
    "repo repository resource see server site stored submission submitted the their this to under uploaded v version via web website with".split()
)


def words(text: str) -> list[str]:
    return re.findall(r"[^\W_]+", canonical(text).casefold())


def squeeze(text: str) -> str:
    return "".join(words(text))


def edits_allowed(n: int) -> int:
    return min(MOST_EDITS, n // LETTERS_PER_EDIT)


def edit_distance(a: str, b: str) -> int:
    """Insertions, deletions, substitutions and swaps of neighbours: the unrestricted
    Damerau-Levenshtein distance, which unlike the restricted one is a true metric."""
    if a == b:
        return 0
    start, end = 0, 0
    short = min(len(a), len(b))
    while start < short and a[start] == b[start]:
        start += 1
    while end < short - start and a[-1 - end] == b[-1 - end]:
        end += 1
    a, b = a[start : len(a) - end], b[start : len(b) - end]
    if not a or not b:
        return len(a) + len(b)
    far = len(a) + len(b)
    last: dict[str, int] = {}
    d = [[far] * (len(b) + 2) for _ in range(len(a) + 2)]
    for i in range(len(a) + 1):
        d[i + 1][1] = i
    for j in range(len(b) + 1):
        d[1][j + 1] = j
    for i in range(1, len(a) + 1):
        match = 0
        above, row = d[i], d[i + 1]
        for j in range(1, len(b) + 1):
            k, m = last.get(b[j - 1], 0), match
            if a[i - 1] == b[j - 1]:
                cost, match = 0, j
            else:
                cost = 1
            row[j + 1] = min(above[j] + cost, row[j] + 1, above[j + 1] + 1, d[k][m] + (i - k - 1) + 1 + (j - m - 1))
        last[a[i - 1]] = i
    return d[-1][-1]


@dataclass
class Node:
    key: str
    below: dict[int, Node | list[tuple[str, int, int]]] = field(default_factory=dict)


def marks(s: str) -> tuple[int, int]:
    """The letters, and the pairs of neighbouring letters, as bits. An edit takes away one letter
    and three pairs at most (a swap does), so that k edits leave at most k and 3 k bits of either
    string without their like."""
    letters = pairs = 0
    for c in s:
        letters |= 1 << (ord(c) & 63)
    for a, b in zip(s, s[1:]):
        pairs |= 1 << ((ord(a) * 37 + ord(b)) & 511)
    return letters, pairs


class BKTree:
    """Strings under the edit metric: one tree for each length, as no edit distance is less
    than the difference of the lengths. Few strings stay a leaf; a leaf that grows beyond LEAF
    is split by the distances to its first string."""

    LEAF = 48

    def __init__(self, keys: Iterable[str]) -> None:
        self.roots: dict[int, Node | list[tuple[str, int, int]]] = {}
        for k in keys:
            self.add(k)

    def add(self, key: str) -> None:
        holder, at = self.roots, len(key)
        while isinstance(node := holder.setdefault(at, []), Node):
            at, holder = edit_distance(key, node.key), node.below
            if at == 0:
                return
        if any(leaf[0] == key for leaf in node):
            return
        node.append((key, *marks(key)))
        if len(node) > self.LEAF:
            split = holder[at] = Node(node[0][0])
            for leaf in node[1:]:
                split.below.setdefault(edit_distance(leaf[0], split.key), []).append(leaf)

    def within(self, query: str, most: int) -> list[tuple[int, str]]:
        """(distance, key) of every key at most `most` away."""
        found, (letters, pairs) = [], marks(query)
        todo = [self.roots[n] for n in range(len(query) - most, len(query) + most + 1) if n in self.roots]
        while todo:
            node = todo.pop()
            if isinstance(node, Node):
                d = edit_distance(query, node.key)
                if d <= most:
                    found.append((d, node.key))
                todo.extend(x for e, x in node.below.items() if d - most <= e <= d + most)
                continue
            for key, their_letters, their_pairs in node:
                apart = max((letters & ~their_letters).bit_count(), (their_letters & ~letters).bit_count())
                if apart <= most and (pairs & ~their_pairs).bit_count() <= 3 * most >= (their_pairs & ~pairs).bit_count():
                    d = edit_distance(query, key)
                    if d <= most:
                        found.append((d, key))
        return sorted(found)


# Kinds of spelling, the better first; a name beats a turned name beats a part of one. A code
# is met exactly or not at all.
FULL, TURNED, PART, CODE = 0, 1, 2, -1
#: Ranks: an exact name, a code, a spelling (with ten for each edit), an abbreviated name; each
#: reading that takes more away than the one before ranks a whole step behind it.
EXACT, CODED, SPELT, ABBREVIATED, STEP = -1, 0, 1, 40, 100
# Kinds of word forms: the word, a beginning of it, its consonants.
WHOLE, BEGINNING, CONSONANTS = 0, 1, 2


class Vocabulary:
    """What is known of a whole list, whichever shard is searched: its words, what a typed word
    can stand for among them, and how long a text can be and still be a name."""

    def __init__(self, names: Iterable[str]) -> None:
        self.words: set[str] = set()
        letters = longest = 0
        for n in names:
            w = words(n or "")
            self.words.update(w)
            letters, longest = max(letters, sum(map(len, w))), max(longest, len(w))
        self._ready(letters, longest)

    @classmethod
    def of_words(cls, listed: Iterable[str], letters: int, longest: int) -> Vocabulary:
        v = cls(())
        v.words = set(listed)
        v._ready(letters, longest)
        return v

    def _ready(self, letters: int, longest: int) -> None:
        #: No text of more words is a spelling within the threshold, nor laid over a name.
        self.most_words = max(letters + MOST_EDITS, 2 * longest)
        self.longest = longest
        self.forms: dict[str, dict[str, int]] = {}
        for w in sorted(self.words):
            bare = w[0] + re.sub("[aeiou]", "", w[1:])
            for kind, forms in ((CONSONANTS, (bare[:k] for k in range(3, len(bare) + 1))), (BEGINNING, (w[:k] for k in range(2, len(w)))), (WHOLE, (w,))):
                for f in forms:
                    kinds = self.forms.setdefault(f, {})
                    kinds[w] = min(kind, kinds.get(w, kind))
        self.tree = BKTree(self.forms)
        self.known: dict[str, dict[str, int]] = {}

    def costs(self, t: str) -> dict[str, int]:
        """Words of the list that t can stand for, with the edits that takes: a word with few
        edits, or one of which t is a beginning or the consonants; if there is none, a word
        of whose beginning t differs by one edit."""
        if t not in self.known:
            found, near = {}, {}
            for d, form in self.tree.within(t, 0 if len(t) < 3 else 1 if len(t) < 7 else 2):
                for w, kind in self.forms[form].items():
                    if d == 0 and (kind == WHOLE or len(t) > 1) or kind == WHOLE and d < len(w) - 1:
                        found[w] = min(d, found.get(w, d))
                    elif kind == BEGINNING and d == 1 and len(t) > 2 < len(form) and max(len(t), len(form)) > 3:
                        near[w] = 1
            if len(self.known) > 100_000:
                self.known.clear()
            self.known[t] = found or near
        return self.known[t]


class Matcher:
    """The tree of one list (or shard of it)."""

    def __init__(self, entries: list[tuple], vocabulary: Vocabulary | None = None) -> None:
        """entries: (registry_id, name, url_pattern, identifiers_pattern, local_pattern, sample_id);
        vocabulary: that of the whole list, if the entries are a shard of it."""
        self.spelt: dict[str, dict[int, int]] = {}
        self.names: dict[int, list[str]] = {}
        self.tells: dict[int, tuple[str, str]] = {}
        self.by_word: dict[str, set[int]] = {}
        for rid, name, url, ids, local, sample in entries:
            w = words(name or "")
            if not w:
                continue
            self.names[rid] = w
            for x in w:
                self.by_word.setdefault(x, set()).add(rid)
            for k in range(1, len(w)):
                self._spell("".join(w[:k]), rid, PART)
                if k > 1:
                    self._spell("".join(x[0] for x in w[:k]), rid, CODE)
                self._spell("".join(w[k:] + w[:k]), rid, TURNED)
            self._spell("".join(w), rid, FULL)
            self._spell("".join(x[0] for x in w), rid, CODE)
            host = re.match(r"\w+://([^/]+)", url or "")
            if host:
                self._spell(squeeze(host[1]), rid, CODE)
                self._spell(squeeze(host[1].split(".")[0]), rid, CODE)
            if ids:
                self._spell(squeeze(re.sub(r"^\w+://", "", ids)), rid, CODE)
            if code := re.match(r"[A-Za-z]+", sample or ""):
                self._spell(code[0].casefold(), rid, CODE)
            self.tells[rid] = (local or "", host[1].lower() if host else "")
        self.tree = BKTree(sorted(self.spelt))
        self.vocabulary = vocabulary or Vocabulary(e[1] for e in entries)
        self.keyed: dict[str, dict[int, int]] = {}

    def _spell(self, key: str, rid: int, kind: int) -> None:
        if key:
            kinds = self.spelt.setdefault(key, {})
            kinds[rid] = kinds.get(rid, 0) | 1 << (kind + 1)

    def best(self, value: str) -> tuple[int, list[int]]:
        """The best rank and all entries that have it; none if the value means no entry."""
        for n, text in enumerate(dict.fromkeys(readings(value, self.vocabulary.most_words))):
            found = self._spellings(squeeze(text)) or dict.fromkeys(self._abbreviated(words(text)), ABBREVIATED)
            if found:
                best = min(found.values())
                return STEP * n + best, sorted(r for r, s in found.items() if s == best)
        return 0, []

    def search(self, value: str, accession: str | None = None, url: str | None = None) -> int:
        """The entry that a value means, 0 for none or for several alike that nothing tells apart."""
        alike = self.best(value)[1]
        typed = [r for r in alike if has_form(accession, self.tells[r][0])]
        hosted = [r for r in alike if url and self.tells[r][1] and self.tells[r][1] in url.lower()]
        first = next((g for g in (typed, hosted, alike) if g), [])
        return first[0] if len(first) == 1 else 0

    def _spellings(self, key: str) -> dict[int, int]:
        """Entries that have a spelling near the key, by rank. No near one ranks before one that
        is the key itself, so that is looked for first."""
        if key not in self.keyed:
            found: dict[int, int] = {}
            for most in dict.fromkeys((0, edits_allowed(len(key)))) if key else ():
                for d, spelling in self.tree.within(key, most):
                    for r, kinds in self.spelt[spelling].items():
                        for kind in (CODE, FULL, TURNED, PART):
                            if not kinds >> (kind + 1) & 1 or kind == CODE and d or kind == PART and d > min(1, len(spelling) // LETTERS_PER_PART_EDIT):
                                continue
                            rank = CODED if kind == CODE else SPELT + 10 * d + kind
                            found[r] = min(found.get(r, rank), rank)
                if found:
                    break
            if len(self.keyed) > 100_000:
                self.keyed.clear()
            self.keyed[key] = found
        return self.keyed[key]

    def _abbreviated(self, typed: list[str]) -> set[int]:
        """Entries whose words are typed in order, each whole, shortened or with few edits. A
        typed word is laid over two words of a name at most, so a longer text is over none."""
        if not 2 <= len(typed) <= 2 * self.vocabulary.longest:
            return set()
        costs = [self.vocabulary.costs(t) for t in typed]
        glued = [self.vocabulary.costs(a + b) for a, b in zip(typed, typed[1:])]
        split = [self._split_costs(t) for t in typed]
        could = {r for w in [*costs[0], *(glued[0] if glued else ()), *(x for x, _ in split[0])] for r in self.by_word.get(w, ())}
        most = edits_allowed(sum(map(len, typed))) or 1
        return {r for r in could if self._aligned(self.names[r], costs, glued, split) <= most}

    def _split_costs(self, t: str) -> list[tuple[str, str]]:
        """Pairs of words of the list that t writes as one."""
        known = self.vocabulary.words
        return [(t[:k], t[k:]) for k in range(2, len(t) - 1) if t[:k] in known and t[k:] in known]

    @staticmethod
    def _aligned(name: list[str], costs: list[dict], glued: list[dict], split: list[list]) -> float:
        """Fewest edits that lay all typed words over the leading two or more words of a name;
        words of the name left over cost nothing, so all entries that share the part fit alike."""
        n, far = len(costs), float("inf")
        best = [[far] * (len(name) + 1) for _ in range(n + 1)]
        best[0][0] = 0
        for i in range(n):
            for j in range(len(name)):
                b = best[i][j]
                if b == far:
                    continue
                if (c := costs[i].get(name[j])) is not None:
                    best[i + 1][j + 1] = min(best[i + 1][j + 1], b + c)
                if i + 1 < n and (c := glued[i].get(name[j])) is not None:
                    best[i + 2][j + 1] = min(best[i + 2][j + 1], b + c)
                if j + 1 < len(name) and (name[j], name[j + 1]) in split[i]:
                    best[i + 1][j + 2] = min(best[i + 1][j + 2], b)
        return min(best[n][2:], default=far)


@lru_cache(maxsize=100_000)
def _pattern(local: str) -> re.Pattern | None:
    try:
        return re.compile(local)
    except re.error:
        return None


def has_form(accession: str | None, local: str | None) -> bool:
    return bool(accession and local and (p := _pattern(local)) and p.fullmatch(accession.strip()))


def readings(value: str, most_words: int) -> Iterator[str]:
    """The value as typed, then with less and less around the name. Of readings without
    wrapping words only those of at most so many words are given: longer ones are no name."""
    text = canonical(value).strip()
    yield text
    bare = re.sub(r"^\w+://", "", text).strip("/: ")
    if bare != text:
        yield bare
    if m := re.fullmatch(r"([\w.-]+):\s*\S+|(.+?)\s*(?:/\s*[\w.-]+|\b(?:no|nr|number)\b\.?\s*\w+)", bare):
        yield m[1] or m[2]
        yield from _unwrapped(m[1] or m[2], most_words)
    if m := re.fullmatch(r"([^()\[\]]*)[(\[]([^()\[\]]*)[)\]]?\W*", text):
        outside, inside = m[1].strip(), m[2].strip()
        for part in (outside, inside):
            if part:
                yield part
                yield from _unwrapped(part, most_words)
        return
    head = re.split(r"\s+[-–—]\s+|[,;:]\s+(?=\w*\d|release|version|v\b)", text, maxsplit=1)[0].strip()
    if head != text:
        yield head
        yield from _unwrapped(head, most_words)
    yield from _unwrapped(text, most_words)


def _unwrapped(text: str, most_words: int) -> Iterator[str]:
    """Wrapping words taken off, first one end at a time, then both."""
    w = words(text)
    left = 0
    while left < len(w) and (w[left] in WRAPPERS):
        left += 1
    right = len(w)
    while right > left and (w[right - 1] in WRAPPERS or w[right - 1].isdigit()):
        right -= 1
    for i in range(max(0, right - most_words), left + 1):
        for j in range(min(len(w), i + most_words), right - 1, -1):
            if (i, j) != (0, len(w)) and i < j:
                yield " ".join(w[i:j])


ENTRY_FIELDS = ("registry_id", "name", "url_pattern", "identifiers_pattern", "local_unique_identifier_pattern", "sample_id")
CANDIDATES = "value string, rank int, registry_id bigint, local string, host string"


def match_names(df: DataFrame, entries: DataFrame, id_col: str = "data_source_id", value: str = "database", accession: str = "accession_number", url: str = "url", entries_per_shard: int = ENTRIES_PER_SHARD) -> DataFrame:
    """(id, value, registry_id, exact): every row whose value is neither null nor blank.

    exact says that the value is an entry's name character for character (of several entries of
    one name the least id); registry_id is 0 when the value means no entry, or several alike
    that neither accession number nor URL tells apart. Repeated rows get the same answer; an
    empty list answers 0 for every value.

    Each distinct value is searched once, in every shard of the list; the answer is the same
    whatever the number of shards.
    """
    rows = df.where(F.col(value).isNotNull() & (F.length(F.trim(F.regexp_replace(value, r"(?U)\s+", " "))) > 0))
    rows = rows.select(F.col(id_col).alias("id"), F.col(value).alias("value"), F.col(accession).alias("acc"), F.col(url).alias("url"))
    fields = entries.select(*ENTRY_FIELDS).where("name IS NOT NULL AND registry_id IS NOT NULL")
    shards = max(1, -(-fields.count() // entries_per_shard))
    asked = rows.select("value").distinct()
    if shards == 1:
        listed = [tuple(r) for r in fields.collect()]  # no more than entries_per_shard
        tasks = rows.sparkSession.sparkContext.defaultParallelism
        found = materialize(asked.repartition(tasks).mapInPandas(_search(listed), CANDIDATES))
    else:
        found = materialize(_sharded(asked, fields, shards))
    per = found.groupBy("value").agg(F.min("rank").alias("rank"))
    best = found.join(per, ["value", "rank"])
    per = best.groupBy("value").agg(F.first("rank").alias("rank"), F.count("*").alias("n"), F.min("registry_id").alias("one"))
    # Few values fit several entries alike; only their rows meet candidates.
    tied = best.join(per.where("n > 1 AND rank >= 0").select("value"), "value").select("value", "registry_id", "local", "host")
    cases = rows.select("value", "acc", "url").join(tied.select("value").distinct(), "value", "left_semi").distinct()
    fits = cases.join(tied, "value").select("value", "acc", "url", "registry_id", _has_form(F.col("acc"), F.col("local")).alias("typed"), ((F.col("host") != "") & F.contains(F.lower("url"), "host")).alias("hosted"))
    of = lambda flag: (F.count(F.when(F.col(flag), 1)).alias(f"n_{flag}"), F.min(F.when(F.col(flag), F.col("registry_id"))).alias(flag))
    told = fits.groupBy("value", "acc", "url").agg(*of("typed"), *of("hosted"))
    means = F.when(F.col("n_typed") == 1, F.col("typed")).when((F.col("n_typed") == 0) & (F.col("n_hosted") == 1), F.col("hosted"))
    told = told.select(*[F.col(c).alias(f"__{c}") for c in ("value", "acc", "url")], means.alias("told"))
    same = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"__{c}")) for c in ("value", "acc", "url")))
    answered = rows.join(per, "value", "left").join(told, same, "left")
    only = F.when((F.col("n") == 1) | (F.col("rank") < 0), F.col("one"))
    return answered.select(F.col("id").alias(id_col), F.col("value").alias(value), F.coalesce(only, "told", F.lit(0)).cast("bigint").alias("registry_id"), F.coalesce(F.col("rank") < 0, F.lit(False)).alias("exact"))


def _search(listed: list[tuple]):
    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matcher = Matcher(listed)
        for b in batches:
            yield _candidates(matcher, listed, b["value"])

    return search


def _has_form(accession: Column, local: Column) -> Column:
    @F.pandas_udf("boolean")
    def form(acc: pd.Series, local: pd.Series) -> pd.Series:
        return pd.Series([has_form(a, p) for a, p in zip(acc, local)], dtype=bool)

    return form(accession, local)


def _candidates(matcher: Matcher, listed: list[tuple], values: Iterable[str]) -> pd.DataFrame:
    """The entries of the best rank of each value; a value that means none has no row."""
    exact, out = {}, []
    for r in sorted(listed, reverse=True):
        exact[r[1]] = r[0]
    for v in values:
        rank, alike = (EXACT, [exact[v]]) if v in exact else matcher.best(v)
        out.extend((v, rank, r, *matcher.tells.get(r, ("", ""))) for r in alike)
    return pd.DataFrame(out, columns=[c.split()[0] for c in CANDIDATES.split(", ")])


@lru_cache(maxsize=1)
def _vocabulary(listed: tuple[str, ...], letters: int, longest: int) -> Vocabulary:
    return Vocabulary.of_words(listed, letters, longest)


def _sharded(asked: DataFrame, fields: DataFrame, shards: int) -> DataFrame:
    """Each distinct value meets each shard of the list, in as few tasks a shard as keep all
    cores at work and no block of values too large. The distinct words of the names travel to
    every task, the entries do not."""
    def name_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            each = [words(n) for n in b["name"]]
            size = pd.DataFrame({"word": [""], "letters": [max((sum(map(len, w)) for w in each), default=0)], "longest": [max(map(len, each), default=0)]})
            yield pd.concat([size, pd.DataFrame({"word": sorted({x for w in each for x in w}), "letters": 0, "longest": 0})])

    known = fields.select("name").mapInPandas(name_words, "word string, letters int, longest int").groupBy("word").agg(F.max("letters").alias("letters"), F.max("longest").alias("longest")).collect()
    listed_words = tuple(sorted(r[0] for r in known if r[0]))
    letters, longest = max((r[1] for r in known), default=0), max((r[2] for r in known), default=0)

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        listed = list(right[list(ENTRY_FIELDS)].itertuples(index=False, name=None))
        return _candidates(Matcher(listed, _vocabulary(listed_words, letters, longest)), listed, left["value"])

    asked = materialize(asked)
    cores = asked.sparkSession.sparkContext.defaultParallelism
    blocks = max(-(-cores // shards), -(-asked.count() // VALUES_PER_BLOCK))
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint")))
    tagged = fields.withColumn("shard", F.pmod(F.xxhash64("registry_id"), F.lit(shards))).withColumn("block", upto(blocks))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("value"), F.lit(blocks))).withColumn("shard", upto(shards))
    return asked.groupBy("shard", "block").cogroup(tagged.groupBy("shard", "block")).applyInPandas(search, CANDIDATES)
