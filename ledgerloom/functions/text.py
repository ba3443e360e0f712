"""Text expressions: normal form, agreement of values, identity masks, character shingles. All stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every line end that the source system's line splitting honours.
LINE_ENDS = r"\r\n|[\n\r\u000b\f\u001c\u001d\u001e\u0085  ]"

# Patterns of identity-bearing text, replaced in this order.
IDENTITY = (
    r"\bIE\d{7}[A-Z]{1,2}\b",
    r"\bIE\d{2}[A-Z]{4}\d{14}\b",
    r"(?i)\bINV[-\s]?\d{4,}\b",
    r"\b\d{2}/\d{2}/\d{4}\b",
    r"\b\d{4}-\d{2}-\d{2}\b",
    r"\b[A-Z]\d{2}\s?[A-Z0-9]{4}\b",
    r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b",
    r"\+?353[-\s]?\d{1,2}[-\s]?\d{3,}[-\s]?\d{3,}",
    r"€\s?\d{1,3}(?:,\d{3})*(?:\.\d{2})?",
)
MASK = "<ID>"


def strip(c: Column) -> Column:
    """Without white space at the ends (trim() takes spaces only; $ would also match before a last line end of any kind)."""
    return F.regexp_replace(c, r"^\s+|\s+\z", "")


def normal(c: Column) -> Column:
    """Lower case, single spaces, no ends; null gives the empty text."""
    return F.coalesce(F.regexp_replace(strip(F.lower(c)), r"\s+", " "), F.lit(""))


def lines(c: Column) -> Column:
    return F.split(c, LINE_ENDS)


def fuzzy_equal(a: Column, b: Column, distance: int = 2) -> Column:
    """Normal forms at most `distance` edits apart."""
    return F.levenshtein(normal(a), normal(b), distance) >= 0


def values_match(a: Column, b: Column, money: bool) -> Column:
    """Two parsed values agree: both null, amounts less than a cent apart, or equal normal forms."""
    if not money:
        same = normal(a) == normal(b)
    else:
        x, y = a.try_cast("double"), b.try_cast("double")
        same = F.when(x.isNotNull() & y.isNotNull(), F.abs(x - y) < 0.01).otherwise(strip(a.cast("string")) == strip(b.cast("string")))
    return F.when(a.isNull() & b.isNull(), True).when(a.isNull() | b.isNull(), False).otherwise(same)


def scored_text(c: Column) -> Column:
    """How scoring compares values: as text, without ends, in lower case."""
    return F.lower(strip(F.coalesce(c.cast("string"), F.lit("None"))))


def mask_identity(c: Column) -> Column:
    for p in IDENTITY:
        c = F.regexp_replace(c, p, MASK)
    return c


def shingles(c: Column, k: int = 5) -> Column:
    """Distinct character k-grams of the text with single spaces; none if it is shorter than k.

    The characters are the variable of an outer transform: they are split once, and each gram is k look-ups.
    """
    t = F.regexp_replace(strip(c), r"\s+", " ")
    grams = lambda x: F.transform(F.sequence(F.lit(0), F.size(x) - k), lambda i: F.concat(*[F.get(x, i + j) for j in range(k)]))
    of = lambda x: F.when(F.size(x) >= k, F.array_distinct(grams(x))).otherwise(F.array().cast("array<string>"))
    return F.get(F.transform(F.array(F.split(t, "")), of), F.lit(0))


def derived_id(family: Column, seed: Column, place: Column) -> Column:
    """Stable document id of a generated document."""
    return F.concat(F.lit("synth-"), F.substring(F.sha2(F.concat_ws("|", family, seed.cast("string"), place.cast("string")), 256), 1, 12))
