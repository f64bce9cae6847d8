"""Texts cut off by field limits or in transfer.

Length evidence: for each table and source a lognormal length distribution is fitted by
maximum likelihood with right-censoring. Lengths, in characters or in UTF-8 bytes, at which
values without an ending pile up far beyond what the fit and the neighbouring lengths
explain are candidate limits, one after another, the fit renewed with what is piled up there
as censored, until nothing is left to explain. The share that is not explained is the
censoring posterior of a value at the limit; elsewhere the source's own rate of cuts in
transfer stands in its place.

Ending evidence: how often cutting the corpus at a random character would leave a text
with this ending (the head of its last sentence and its last words, names and numbers
abstracted), against how often texts do end so. Endings of complete texts occur far more
often than cutting explains. A mark of the cutting system, a broken character and a tag cut
through or left open are endings that hardly any complete text has. Both kinds of evidence
are combined as odds, for every text alike.
"""

from __future__ import annotations

import math
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.operators.partitioning import spread
from folioforge.session import materialize

# What systems put after a text they have cut, and the sign of a broken character.
MARKER = r"(?:…|\.\.\.|\[(?:…|\.\.\.|more|cut|truncated|continued)\]|\((?:…|\.\.\.|more|cut|truncated|continued)\)|\x{FFFD})\s*$"
# Words whose full stop ends no sentence.
ABBREVIATIONS = "e.g i.e cf fig figs approx vs al ca no nos ref refs eq eqs suppl resp incl ed vol p pp".split()
# Signs that end a sentence, and those that may follow them.
STOPS, CLOSERS = (".", "!", "?"), (")", "]", '"', "'", "\u201d", "\u2019", "\u00bb")
# Tags that are closed again.
PAIRED = "p|strong|em|b|i|u|sub|sup|span|li|ul|ol|div|td|tr|table|h[1-6]"
#: A pile of unended values that chance explains with this probability makes no limit.
CHANCE = 1e-6
#: Evidence of an ending weighs as much as so many observations of the coarser one behind it.
SMOOTHING = 3.0
#: Cuts are not spread evenly: up to so many times the expected number is no sign of a complete ending.
UNEVEN = 8.0
#: Characters of a sentence: one cut in so many falls exactly on its end.
SENTENCE_CHARS = 80
#: Chance that an ending seen nowhere else comes of a cut, if cutting the corpus can and if it can't give its head.
REACHABLE, UNREACHABLE = 0.9, 0.3
#: What an ending that no cut of the corpus can leave takes off the chance, at the middle and the finest grain.
UNREACHED = {"_mid": 0.2, "": 0.7}
#: Chance that a text with a mark of cutting, a broken character or an open tag was cut.
MARKED = 0.9999
#: Words up to this length stand for themselves in the context model, longer ones by as many first characters and a hash.
PLAIN_WORD = 24
#: Words of a sentence that are carried through the count together.
STRETCH = 64


def _clean(text: Column) -> Column:
    return F.rtrim(F.when(text.contains("<"), F.regexp_replace(text, r"</?[A-Za-z][^<>]*>", "")).otherwise(text))


def _shape(clean: Column) -> Column:
    """Numbers, codes and names inside sentences by one sign each; sentence heads stay."""
    s = F.regexp_replace(clean, r"\p{Lu}(?<=[^.!?)\s][\s-]{1,2}\p{Lu})\p{Ll}+", "Xx")
    s = F.regexp_replace(s, r"\p{Lu}{2,}", "X")
    return F.regexp_replace(s, r"\d+", "9")


def _sentences(shape: Column) -> Column:
    """Arrays of words of each sentence, enumerators at its head left out."""
    enumerator = r"(?:(?:\(?\p{Lu}\)|\p{Lu},)\s*)?"
    parts = F.split(F.regexp_replace(shape, rf"^\s*{enumerator}", ""), rf"(?<=[.!?][)\]]?)\s+{enumerator}|\s*\n\s*{enumerator}")
    return F.transform(F.filter(parts, lambda s: s != ""), lambda s: F.split(s, r"\s+"))


KEY = ["h1", "h2", "p2", "p1", "w"]


def _key(word: Column) -> Column:
    return F.when(F.length(word) <= PLAIN_WORD, word).otherwise(F.concat(F.substring(word, 1, PLAIN_WORD), F.lit("#"), F.hex(F.xxhash64(word))))


def _word(words: Column, k: Column) -> Column:
    return F.coalesce(_key(F.try_element_at(words, k)), F.lit("^"))


def prepare(df: DataFrame) -> DataFrame:
    """(table_name, row_id, source, text) -> the same with lengths and the signs of an ending."""
    clean = _clean(F.col("text"))
    rows = df.where(F.col("text").isNotNull() & (F.length(F.trim("text")) > 0)).withColumn("clean", clean)
    tagged = F.col("text").contains("<")
    opened, closed = F.regexp_count("text", F.lit(f"(?i)<(?:{PAIRED})\\b[^<>]*>")), F.regexp_count("text", F.lit(f"(?i)</(?:{PAIRED})\\s*>"))
    tail = F.right("clean", F.lit(64))  # longer than any ending that is told by its form
    last, stopped = F.right("clean", F.lit(1)), F.col("clean").endswith(".")
    word = F.lower(F.substring_index(F.substring_index(F.regexp_replace(tail, r"\s", " "), " ", -1), "(", -1))
    # patterns are tried only where the last sign lets them match
    short = stopped & word.isin(*[f"{w}." for w in ABBREVIATIONS])
    stop = (last.isin(*STOPS) | (last.isin(*CLOSERS) & tail.rlike(r"[.!?][)\]\"'”’»]*$"))) & ~short
    number = stopped & F.substring("clean", -2, 1).between("0", "9") & tail.rlike(r"(?:^|[^\d.,])\d+\.$")
    mark = (last.isin("\u2026", "]", ")", "\ufffd") | F.col("clean").endswith("...")) & tail.rlike(MARKER)
    return rows.select(
        "table_name", "row_id", F.coalesce("source", F.lit("")).alias("source"),
        F.length("text").alias("n_chars"), F.octet_length("text").alias("n_bytes"),
        (mark | F.when(tagged, F.col("clean").rlike(r"<[/A-Za-z]?[^<>\s]*$") | (opened > closed)).otherwise(False)).alias("marked"),
        stop.alias("ended"),
        (~stop | number).alias("open"),
        F.xxhash64("clean").alias("text_id"),
        _sentences(_shape(F.col("clean"))).alias("sentences"),
    )


def tails(prepared: DataFrame) -> DataFrame:
    """The rows with the key of their ending and the length of its last word."""
    last = F.coalesce(F.try_element_at(F.col("sentences"), F.lit(-1)), F.array(F.lit("^")))
    n = F.size("last")
    return prepared.withColumn("last", last).select(
        *prepared.columns,
        _word(F.col("last"), F.lit(1)).alias("h1"), _word(F.col("last"), F.lit(2)).alias("h2"),
        F.when(n > 2, _word(F.col("last"), n - 2)).otherwise("^").alias("p2"), F.when(n > 1, _word(F.col("last"), n - 1)).otherwise("^").alias("p1"),
        _word(F.col("last"), F.lit(-1)).alias("w"), F.length(F.try_element_at("last", F.lit(-1))).alias("w_length"),
    )


def contexts(prepared: DataFrame) -> DataFrame:
    """Every distinct word of the corpus with its context, how often it stands there (n) and how
    often the text goes on behind it (followed); counted with map-side combining."""
    # Sentences are taken apart into stretches of bounded length with the two words before them,
    # so that no exploded row carries more than one stretch.
    def stretches(words: Column, s: Column) -> Column:
        at = lambda k: _key(F.coalesce(F.get(words, F.lit(k)), F.lit("^")))
        return F.transform(
            F.sequence(F.lit(0), F.size(words) - 1, F.lit(STRETCH)),
            lambda a: F.struct(
                a.alias("a"), at(0).alias("h1"), at(1).alias("h2"), F.slice(words, F.greatest(a - 1, F.lit(1)), F.least(a, F.lit(2)) + STRETCH).alias("part"),
                F.when(s + 1 == F.size("sentences"), F.size(words) - 1).otherwise(-1).alias("very_last"),
            ),
        )

    parts = prepared.select(F.inline(F.flatten(F.transform("sentences", stretches)))).select("*", F.posexplode("part").alias("j", "w"))
    k = F.greatest(F.col("a") - 2, F.lit(0)) + F.col("j")
    before = lambda d: _key(F.get("part", F.col("j") - d))
    words = parts.withColumn("k", k).where("k >= a").select(
        F.when(F.col("k") >= 1, F.col("h1")).otherwise("?").alias("h1"), F.when(F.col("k") >= 2, F.col("h2")).otherwise("?").alias("h2"),
        F.when(F.col("k") >= 2, before(2)).otherwise("^").alias("p2"), F.when(F.col("k") >= 1, before(1)).otherwise("^").alias("p1"),
        "w", F.least("k", F.lit(2)).alias("place"), F.when(F.col("k") == F.col("very_last"), 0).otherwise(1).alias("goes_on"),
    )
    return words.groupBy("h1", "h2", "p2", "p1", "w", "place").agg(F.count("*").alias("n"), F.sum("goes_on").alias("followed"))


def cut_positions(counted: DataFrame, ends: DataFrame) -> DataFrame:
    """(key, n): characters of the corpus at which a cut would leave an ending of that key.

    Words are taken apart only where some text of the corpus ends in the same sentence head and
    behind the same word, and only into beginnings as long as the last words there. A cut
    right behind the stop of a sentence leaves no ending to tell and is not counted here.
    """
    lengths = lambda rows: F.array_sort(F.collect_set("w_length"))  # noqa: E731, ARG005
    at_head = ends.where("p1 = '^'").agg(lengths(ends)).first()[0]
    asked = ends.where("p1 <> '^'").groupBy("h1", "p1").agg(lengths(ends).alias("lengths"))
    first = counted.where("place = 0").withColumn("lengths", F.lit(at_head) if at_head else F.array().cast("array<int>"))
    later = counted.where("place > 0").join(asked, ["h1", "p1"])
    both = first.unionByName(later)
    begun = both.withColumn("k", F.explode(F.filter("lengths", lambda k: k <= F.length("w")))).withColumn("t", _key(F.expr("substring(w, 1, k)")))
    # A sentence cut within its first or second word has the part as its head.
    n = F.when(F.col("k") < F.length("w"), F.col("n")).when(F.col("w").rlike(r"[.!?]$"), 0).otherwise(2 * F.col("followed"))
    keys = begun.select(
        F.when(F.col("place") == 0, F.col("t")).otherwise(F.col("h1")).alias("h1"),
        F.when(F.col("place") == 0, "^").when(F.col("place") == 1, F.col("t")).otherwise(F.col("h2")).alias("h2"),
        "p2", "p1", F.col("t").alias("w"), n.alias("n"),
    )
    return keys.groupBy(*KEY).agg(F.sum("n").alias("n")).where("n > 0")


def _levels(counted: DataFrame, ends: DataFrame) -> DataFrame:
    """For each key of an observed ending: observed ends and cut positions, at three grains."""
    positions = cut_positions(counted, ends)
    # Both by all three grains at once, from the fine counts.
    grain = lambda name, key: F.struct(F.lit(name).alias("grain"), *[(F.col(c) if c in key else F.lit("")).alias(c) for c in KEY])
    grains = {"": KEY, "_mid": ["h1", "p1", "w"], "_top": ["h1"]}
    either = ends.select(*KEY, "e", F.lit(0).cast("long").alias("n")).unionByName(positions.select(*KEY, F.lit(0).cast("long").alias("e"), "n"))
    # The coarsest grain counts every character behind the head, whether a text ends there or not.
    wide = F.when(F.col("w").rlike(r"[.!?]$"), 0).otherwise(2 * F.col("followed")) + (F.length("w") - 1) * F.col("n")
    tops = counted.where("place > 0").groupBy("h1").agg(F.sum(wide).alias("n")).join(ends.select("h1").distinct(), "h1", "left_semi")
    by_grain = either.select(F.explode(F.array(*[grain(g, k) for g, k in grains.items()])).alias("g"), "e", F.when((F.col("p1") == "^") | (F.col("g.grain") != "_top"), F.col("n")).otherwise(0).alias("n")).select("g.*", "e", "n")
    whole = by_grain.unionByName(tops.select(F.lit("_top").alias("grain"), "h1", *[F.lit("").alias(c) for c in KEY[1:]], F.lit(0).cast("long").alias("e"), "n"))
    sums = materialize(whole.groupBy("grain", *KEY).agg(F.sum("e").alias("e"), F.sum("n").alias("n")).where("e > 0"))
    out = None
    for g, key in grains.items():
        part = sums.where(F.col("grain") == g).select(*key, F.col("e").alias(f"e{g}"), F.col("n").alias(f"n{g}"))
        out = part if out is None else out.join(part, key)
    return out


def _pooled_rate(levels: DataFrame) -> float:
    """Cuts for each character of the corpus: the median, over sentence heads weighted by
    their characters, of observed ends for each cut position. Heads of complete endings lie
    above it; most characters stand under heads that only a cut can end."""
    heads = levels.groupBy("h1").agg(F.first("e_top").alias("e"), F.first("n_top").alias("n")).where("n > 0")
    steps = heads.selectExpr("round(log2(e / n) * 8) AS step", "n").groupBy("step").agg(F.sum("n").alias("n")).orderBy("step").collect()  # a row for each eighth of a power of two
    total, seen = sum(r["n"] for r in steps), 0
    for r in steps:
        seen += r["n"]
        if seen * 2 >= total:
            return 2.0 ** (r["step"] / 8)
    return 0.0


LIMITS = "table_name string, source string, unit string, size_limit int, length int, p_open double, p_ended double, mu double, sigma double, n long, censored long"


def fit_censored(lengths: np.ndarray, counts: np.ndarray, limits: np.ndarray, censored: np.ndarray, rounds: int = 60) -> tuple[float, float]:
    """Maximum-likelihood mu and sigma of log length, some values known only to exceed a limit."""
    x, c = np.log(lengths), np.log(np.maximum(limits, 2)) if len(limits) else np.empty(0)
    n, m = counts.sum(), censored.sum() if len(limits) else 0
    if n + m == 0:
        return 0.0, 1.0
    mu = float((counts * x).sum() / n) if n else float(c.mean())
    sigma = max(0.05, math.sqrt(float((counts * (x - mu) ** 2).sum() / n)) if n else 0.5)
    nd = NormalDist()
    for _ in range(rounds if m else 0):
        z = (c - mu) / sigma
        hazard = np.array([nd.pdf(v) / max(1e-12, 1 - nd.cdf(v)) for v in z])
        first = mu + sigma * hazard
        second = mu**2 + sigma**2 + sigma * hazard * (c + mu)
        mu_new = ((counts * x).sum() + (censored * first).sum()) / (n + m)
        var = ((counts * x * x).sum() + (censored * second).sum()) / (n + m) - mu_new**2
        sigma_new = math.sqrt(max(var, 0.0025))
        done = abs(mu_new - mu) + abs(sigma_new - sigma) < 1e-6
        mu, sigma = float(mu_new), float(sigma_new)
        if done:
            break
    return mu, sigma


def _poisson_tail(k: float, mean: float) -> float:
    """P(X >= k), bounded from above by Chernoff where that is enough."""
    return 1.0 if k <= mean else math.exp(k - mean - k * math.log(k / mean)) if mean > 0 else 0.0


def _best_pile(left: pd.DataFrame, natural: NormalDist, total: int, open_share: float) -> tuple | None:
    """The length, in either unit, whose unended values exceed what the fit and the neighbouring
    lengths explain by most: (excess, values there, unit, length, width, explained)."""
    best = None
    for unit, width in (("n_chars", 2), ("n_bytes", 4)):
        h = left.groupby(unit)[["n_open", "chars"]].sum()
        if h.empty:
            continue
        size = int(h.index.max()) + 1
        dense = np.zeros(size + width + 1)
        dense[h.index.to_numpy()] = h["n_open"].to_numpy()
        chars = (h["chars"] / left.groupby(unit)["n"].sum()).to_dict()
        sums = np.concatenate([[0], np.cumsum(dense)])
        for at in h.index[h["n_open"] >= 0.5]:
            pile = sums[at + 1] - sums[max(0, at + 1 - width)]
            if dense[at] < 0.3 * pile:
                continue
            reach = max(12, at // 8)
            lo, hi = max(1, at - reach), min(len(dense) - 1, at + reach)
            around = (sums[hi + 1] - sums[lo]) - (sums[min(at + 3, hi + 1)] - sums[max(at - 5, lo)])
            n = max(2.0, chars[at])
            fitted = total * open_share * (natural.cdf(math.log(n + 1)) - natural.cdf(math.log(max(1.0, n + 1 - width))))
            expected = max(0.3 * width, around / max(1, hi - lo + 1 - 8) * width, fitted)
            excess = pile - expected
            if _poisson_tail(pile, expected) < CHANCE and (best is None or (excess, dense[at]) > best[:2]):
                best = (excess, dense[at], unit, int(at), width, expected)
    return best


def limits_of(pdf: pd.DataFrame) -> pd.DataFrame:
    """Candidate limits of one table and source from its histogram of lengths: as many as there
    are; each round takes the values of one out of the histogram and renews the fit."""
    table, source = pdf["table_name"].iloc[0], pdf["source"].iloc[0]
    left = pdf.assign(chars=pdf["n_chars"] * pdf["n"])
    total = int(pdf["n"].sum())
    found = []
    while True:
        lengths = left.groupby("n_chars")["n"].sum()
        mu, sigma = fit_censored(lengths.index.to_numpy(float), lengths.to_numpy(float), np.array([f[6] for f in found]), np.array([float(f[3]) for f in found]))
        nd = NormalDist(mu, sigma)
        open_share = left["n_open"].sum() / max(1, left["n"].sum())
        best = _best_pile(left, nd, total, open_share)
        if best is None:
            break
        _, _, unit, at, width, expected = best
        mask = (left[unit] > at - width) & (left[unit] <= at)
        found.append((unit, at, width, float(left.loc[mask, "n_open"].sum()), float(left.loc[mask, "n_ended"].sum()), expected, float(left.loc[mask, "n_chars"].mean())))
        left = left[~mask]
    rows = []
    for unit, at, width, n_open, n_ended, expected, chars in found:
        fitted = total * (nd.cdf(math.log(chars + 1)) - nd.cdf(math.log(max(1.0, chars + 1 - width)))) * open_share
        p_open = max(0.0, 1 - max(expected, fitted) / n_open)
        p_ended = min(1.0, n_open * p_open / SENTENCE_CHARS / max(1.0, n_ended))
        natural_each = max(expected, fitted) / width
        for k in range(at - width + 1, at + 1):
            here = float(pdf.loc[pdf[unit] == k, "n_open"].sum())
            if here > 2 * natural_each:
                rows.append((table, source, unit, at, k, 1 - natural_each / here, p_ended, mu, sigma, total, round(n_open)))
    if not rows:
        rows = [(table, source, "", 0, 0, 0.0, 0.0, mu, sigma, total, 0)]
    return pd.DataFrame(rows, columns=[c.split()[0] for c in LIMITS.split(", ")])


def source_limits(scored: DataFrame) -> DataFrame:
    """Fit and candidate limits of every table and source, from histograms of lengths in
    which an open ending counts with its probability of coming of a cut."""
    hist = scored.groupBy("table_name", "source", "n_chars", "n_bytes").agg(
        F.count("*").alias("n"), F.sum(F.when(F.col("ended"), 0.0).otherwise(F.col("p_key"))).alias("n_open"), F.sum(F.col("ended").cast("int")).alias("n_ended")
    )
    return hist.groupBy("table_name", "source").applyInPandas(limits_of, LIMITS)


def _odds(p: Column) -> Column:
    q = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return q / (1 - q)


def judge(df: DataFrame) -> DataFrame:
    """(table_name, row_id, source, p_cut) for every row of (table_name, row_id, source, text).

    Null, empty and blank texts are left out: they are no cases. Repeated rows are judged
    each, but count as one ending among the observed. A null source is a source of its own.
    """
    prepared = materialize(tails(prepare(spread(df))))
    rows = prepared.drop("sentences", "w_length")
    ends = materialize(prepared.where(F.col("open") & ~F.col("marked")).select(*KEY, "w_length", "text_id").distinct().groupBy(*KEY).agg(F.count("*").alias("e"), F.max("w_length").alias("w_length")))
    levels = _levels(materialize(contexts(prepared)), ends)
    rate = _pooled_rate(levels)

    def share(level: str, behind: Column) -> Column:
        cuts = F.lit(UNEVEN * rate) * F.col(f"n{level}")
        if level in UNREACHED:
            behind = F.when(F.col(f"n{level}") > 0, behind).otherwise(behind * UNREACHED[level])
        return (cuts + SMOOTHING * behind) / (F.greatest(F.col(f"e{level}") - 1, cuts) + SMOOTHING)  # the ending itself is no evidence

    unseen = F.when(F.col("n_top") > 0, REACHABLE).otherwise(UNREACHABLE)
    keys = levels.withColumn("p_top", share("_top", unseen)).withColumn("p_mid", share("_mid", F.col("p_top"))).withColumn("p_key", share("", F.col("p_mid")))
    p_end = F.when(F.col("marked"), MARKED).when(F.col("open"), F.coalesce("p_key", F.lit(0.0))).otherwise(0.0)
    scored = materialize(
        rows.join(keys.select(*KEY, "p_key"), KEY, "left").select("table_name", "row_id", "source", "n_chars", "n_bytes", "marked", (F.col("open") | F.col("marked")).alias("open"), (F.col("ended") & ~F.col("marked")).alias("ended"), p_end.alias("p_key"))
    )
    limits = materialize(source_limits(scored))
    for unit in ("n_chars", "n_bytes"):
        at = limits.where(F.col("unit") == unit).groupBy("table_name", "source", F.col("length").alias(unit)).agg(F.max("p_open").alias(f"open_{unit}"), F.max("p_ended").alias(f"ended_{unit}"))
        scored = scored.join(at, ["table_name", "source", unit], "left")
    p_limit = F.greatest(*(F.coalesce(F.when(F.col("ended"), F.col(f"ended_{u}")).otherwise(F.col(f"open_{u}")), F.lit(0.0)) for u in ("n_chars", "n_bytes")))
    at_limit = F.coalesce("open_n_chars", "open_n_bytes").isNotNull()
    scored = scored.select("table_name", "row_id", "source", "marked", "open", "p_key", p_limit.alias("p_limit"), at_limit.alias("at_limit"))
    plain = F.col("open") & ~F.col("marked")
    own = scored.where(plain & ~F.col("at_limit")).groupBy("table_name", "source").agg(F.sum("p_key").alias("s"), F.count("*").alias("n"))
    pooled = scored.where(plain).agg(F.avg("p_key")).first()[0] or 0.5
    # A mark comes with the cut wherever that falls, so the pile at a limit says nothing against it.
    transfer = (F.coalesce("s", F.lit(0.0)) + pooled) / (F.coalesce("n", F.lit(0)) + 1)
    prior = F.when(F.col("at_limit"), F.when(F.col("marked"), F.greatest("p_limit", transfer)).otherwise(F.col("p_limit"))).otherwise(transfer)
    odds = _odds(F.col("p_key")) / _odds(F.lit(float(pooled))) * _odds(prior)
    p_cut = F.when(F.col("open"), odds / (1 + odds)).otherwise(F.col("p_limit"))
    return scored.join(F.broadcast(own) if _few(own) else own, ["table_name", "source"], "left").select("table_name", "row_id", "source", p_cut.alias("p_cut"))


def _few(df: DataFrame, rows: int = 50_000) -> bool:
    return df.limit(rows + 1).count() <= rows
