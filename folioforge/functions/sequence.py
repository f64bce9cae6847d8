"""Panel-label sequences: letters, numbers and Roman numerals, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The form of Roman numerals, up to four thousands, and the digits.
ROMAN = r"^(?=[MDCLXVI])M{0,4}(CM|CD|D?C{0,3})(XC|XL|L?X{0,3})(IX|IV|V?I{0,3})$"
DIGITS = {"I": 1, "V": 5, "X": 10, "L": 50, "C": 100, "D": 500, "M": 1000}
# First labels by which a list counts as Roman.
FIRST_ROMANS = ("I", "II", "III", "IV", "V", "VI", "VII", "VIII", "IX", "X")
# What is said of a list of labels.
NO_LABELS = "No panel labels provided"
UNKNOWN_KIND = "Unable to determine sequence type from labels"
FOREIGN_LETTER = "Labels contain characters not in the expected alphabet"
FOREIGN_NUMBER = "Invalid numeric value in sequence"
FOREIGN_ROMAN = "Invalid Roman numeral in sequence: "
VALID, GAPS = "Sequence is valid", "Sequence has gaps. Fixed sequence: "
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def is_roman(s: Column) -> Column:
    return F.upper(s).rlike(ROMAN)


def roman_to_int(s: Column) -> Column:
    """-1 for a text with any other letter; a smaller digit before a larger one counts down."""
    value = F.create_map(*[x for k, v in DIGITS.items() for x in (F.lit(k), F.lit(v))])
    chars = F.filter(F.split(F.upper(s), ""), lambda c: c != "")
    start = F.struct(F.lit(0).alias("total"), F.lit(0).alias("before"))
    step = lambda a, c: F.struct(
        F.when(value[c] < a["before"], a["total"] - value[c]).otherwise(a["total"] + value[c]).alias("total"), value[c].alias("before")
    )
    known = F.forall(chars, lambda c: c.isin(*DIGITS))
    return F.when(known, F.aggregate(F.reverse(chars), start, step, lambda a: a["total"])).otherwise(F.lit(-1))


def int_to_roman(n: Column) -> Column:
    """1 to 4999; null beyond."""
    tables = [["", *(x.translate(t) for x in ("I", "II", "III", "IV", "V", "VI", "VII", "VIII", "IX"))] for t in (str.maketrans("IVX", y) for y in ("IVX", "XLC", "CDM"))]
    place = lambda k: F.element_at(F.array(*[F.lit(x) for x in tables[k]]), (F.floor(n / 10**k) % 10 + 1).cast("int"))
    return F.when((n > 0) & (n < 5000), F.concat(F.repeat(F.lit("M"), F.floor(n / 1000).cast("int")), place(2), place(1), place(0)))


def bare_labels(labels: Column) -> Column:
    """Labels without brackets, stops and blanks around or in them."""
    return F.transform(labels, lambda x: F.regexp_replace(x, r"[().\s]", ""))


def family(labels: Column) -> Column:
    """roman, upper, lower, digits or invalid, by the first label; I to X count as Roman. A
    stretch of the alphabet counts as letters, and so does an empty label."""
    first = F.try_element_at(labels, F.lit(1))
    among = lambda letters: F.contains(F.lit(letters), first)
    return (
        F.when(first.isin(*FIRST_ROMANS), "roman").when(among(LETTERS), "upper").when(among(LETTERS.lower()), "lower")
        .when(first.rlike("^[0-9]+$"), "digits").otherwise("invalid")
    )


def expected_labels(labels: Column) -> Column:
    """The unbroken run from the first to the last label of the family (for Roman numerals from
    the least to the greatest), empty if it would go backwards; null if a label is foreign to it."""
    kind = family(labels)
    first, last = F.try_element_at(labels, F.lit(1)), F.try_element_at(labels, F.lit(-1))
    none = F.array().cast("array<string>")

    def letters(alphabet: str) -> Column:
        a, b = F.instr(F.lit(alphabet), first), F.instr(F.lit(alphabet), last)
        run = F.slice(F.array(*[F.lit(x) for x in alphabet]), F.greatest(a, F.lit(1)), F.greatest(b - a + 1, F.lit(0)))
        return F.when((a > 0) & (b > 0), run)

    n, m = first.try_cast("int"), last.try_cast("int")
    numbers = F.when(F.forall(labels, lambda x: x.try_cast("int").isNotNull()), F.when(n <= m, F.transform(F.sequence(n, m), lambda k: k.cast("string"))).otherwise(none))
    values = F.transform(labels, roman_to_int)
    romans = F.when(F.forall(labels, is_roman), F.transform(F.sequence(F.array_min(values), F.array_max(values)), int_to_roman))
    return F.when(kind == "roman", romans).when(kind == "upper", letters(LETTERS)).when(kind == "lower", letters(LETTERS.lower())).when(kind == "digits", numbers)


def verify(labels: Column) -> Column:
    """struct(is_valid, fixed_sequence, details) of a list of bare labels: whether it is its own
    unbroken run, in order (Roman numerals as a set, numbers by value); the run, or the labels
    themselves where one is foreign to it. Null and empty lists are not valid."""
    kind, want = family(labels), expected_labels(labels)
    values = F.transform(labels, roman_to_int)
    as_set = F.size(F.array_distinct(values)) == F.size(want)
    same = F.when(kind == "roman", as_set).when(kind == "digits", F.transform(labels, lambda x: x.try_cast("int").cast("string")) == want).otherwise(labels == want)
    valid = F.coalesce(want.isNotNull() & same, F.lit(False))
    foreign = F.when(kind == "roman", F.concat(F.lit(FOREIGN_ROMAN), F.get(F.filter(labels, lambda x: ~is_roman(x)), F.lit(0)))).when(kind == "digits", FOREIGN_NUMBER).when(kind == "invalid", UNKNOWN_KIND).otherwise(FOREIGN_LETTER)
    told = F.when(valid, VALID).when(want.isNull(), foreign).otherwise(F.concat(F.lit(GAPS), F.array_join(want, ", ")))
    none = F.coalesce(F.size(labels) <= 0, F.lit(True))
    return F.struct(
        (valid & ~none).alias("is_valid"), F.when(none, F.array().cast("array<string>")).otherwise(F.coalesce(want, labels)).alias("fixed_sequence"), F.when(none, NO_LABELS).otherwise(told).alias("details")
    )


def is_sequence(labels: Column) -> Column:
    """Whether the labels are their own run: in order, but for Roman numerals as a set.
    An empty list is none."""
    return verify(labels)["is_valid"]
