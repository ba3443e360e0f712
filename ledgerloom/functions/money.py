"""Amounts and dates: parsing, formatting, VAT arithmetic, business days."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions.text import strip

# Amounts with two decimals; in a table the currency may be missing.
MONEY = r"(?i)(?:€|EUR)\s*([\d,]+\.\d{2})|([\d,]+\.\d{2})\s*(?:€|EUR)"
TABLE_MONEY = r"(?i)(?:€|EUR)?\s*([\d,]+\.\d{2})|([\d,]+\.\d{2})\s*(?:€|EUR)?"

# Statutory rates in per cent, and how far a ratio may be from one.
RATES = (0.0, 4.8, 9.0, 13.5, 23.0)
RATIO_TOLERANCE = 0.005

# Weights of the digits of a VAT number.
VAT_WEIGHTS = (8, 7, 6, 5, 4, 3, 2)

# Date formats in the order they are tried. Days and months have one digit or two, years four.
DATE_FORMATS = ("d/M/y", "y-M-d", "d-M-y", "d.M.y", "y/M/d", "d MMM y", "d MMMM y")
DATE_SHAPES = {"d": r"\d{1,2}", "M": r"\d{1,2}", "y": r"\d{4}", "MMM": "[A-Za-z]{3}", "MMMM": "[A-Za-z]{3,}"}

# Tax types by rate, and the countries that count as home or as other member states.
TAX_TYPES = {
    "23": "VAT on Expenses",
    "13.5": "VAT 13.5% on Expenses",
    "9": "VAT 9% on Expenses",
    "4.8": "VAT 4.8% on Expenses",
    "0": "Zero Rated Expenses",
    "RC": "Reverse Charge Expenses (20%)",
    "EC": "EC Acquisitions (Zero Rated)",
    "": "Zero Rated Expenses",
}
HOME = ("IE", "EI", "IRELAND")
MEMBER_STATES = ("GB", "UK", "DE", "FR", "ES", "IT", "NL", "BE", "DK", "SE", "FI", "PL", "PT", "AT")


def rounded(x: Column, digits: int = 2) -> Column:
    """A double rounded half-even by its exact binary value, as the source system rounds: 2.675 gives 2.67.

    round() and bround() look at the shortest decimal instead. The product with 10**digits is kept exactly, as a
    rounded part and its error (Dekker's product), so a near tie falls on its true side.
    """
    x, ten = x.cast("double"), 10**digits
    p = x * float(ten)
    high = x * 134217729.0 - (x * 134217729.0 - x)
    error = (high * float(ten) - p) + (x - high) * float(ten)
    low = F.floor(p).cast("double")
    over = p - low - 0.5
    up = (over > 0) | ((over == 0) & ((error > 0) | ((error == 0) & (low % 2 != 0))))
    return (low + up.cast("double")) / float(ten)


def two_decimals(x: Column) -> Column:
    return F.format_string("%.2f", rounded(x))


def first_amount(c: Column, pattern: str = MONEY) -> Column:
    """The first amount in a text, or null."""
    found = F.coalesce(*[F.nullif(F.regexp_extract(c, pattern, g), F.lit("")) for g in (1, 2)])
    return F.replace(found, F.lit(","), F.lit("")).try_cast("double")


def all_amounts(c: Column) -> Column:
    # with the currency around it, each match holds one amount
    return F.transform(F.regexp_extract_all(c, F.lit(MONEY), F.lit(0)), lambda m: first_amount(m))


def first_quantity(c: Column) -> Column:
    return F.nullif(F.regexp_extract(c, r"(\d+(?:\.\d+)?)", 1), F.lit("")).try_cast("double")


def net_ratio(rate: float) -> float:
    """VAT as a part of the gross amount."""
    return (rate / 100) / (1 + rate / 100)


def near_statutory(ratio: Column) -> Column:
    return F.exists(F.array(*[F.lit(net_ratio(r)) for r in RATES]), lambda x: F.abs(ratio - x) < RATIO_TOLERANCE)


def plausible_ratio(vat: Column, total: Column) -> Column:
    """VAT over total is near a statutory rate; a total that is not positive is not plausible."""
    return F.when(total > 0, near_statutory(F.try_divide(vat, total))).otherwise(False)


def vat_number_plausible(c: Column) -> Column:
    """Shape of a VAT number, and a weighted digit sum that 23 does not divide."""
    digits = [F.substring(c, 3 + i, 1).try_cast("int") * w for i, w in enumerate(VAT_WEIGHTS)]
    total = digits[0]
    for d in digits[1:]:
        total = total + d
    return F.when(F.regexp_like(c, F.lit(r"^IE\d{7}[A-Z]{1,2}$")), total % 23 != 0).otherwise(False)


def _date_shape(form: str) -> str:
    """The pattern of texts that a format may be tried on: a format alone takes years of any width."""
    return "^" + re.sub(r"M+|[dy]", lambda m: DATE_SHAPES[m[0]], form.replace(".", r"\.")) + "$"


def format_date(c: Column) -> Column:
    """dd/MM/yyyy of the first format that fits; other text stays, null and empty give the empty text."""
    t = strip(c)
    tried = F.coalesce(*[F.when(F.regexp_like(t, F.lit(_date_shape(f))), F.try_to_timestamp(t, F.lit(f))) for f in DATE_FORMATS])
    return F.when(F.coalesce(c, F.lit("")) == "", F.lit("")).otherwise(F.coalesce(F.date_format(tried, "dd/MM/yyyy"), t))


def due_date(formatted: Column, days: int) -> Column:
    """Some days after a date as format_date() writes it; the empty text if it is none."""
    day = F.to_date(F.when(F.regexp_like(formatted, F.lit(_date_shape("d/M/y"))), F.try_to_timestamp(formatted, F.lit("d/M/y"))))
    return F.coalesce(F.date_format(F.date_add(day, days), "dd/MM/yyyy"), F.lit(""))


def _weekdays(day: Column) -> Column:
    """Weekdays from a fixed Monday to the day, itself included."""
    n = F.datediff(day, F.to_date(F.lit("1900-01-01")))
    return F.floor(n / 7) * 5 + F.least(n % 7 + 1, F.lit(5))


def business_days(start: Column, end: Column) -> Column:
    """Weekdays after start up to end; 0 if end is not later."""
    return F.when(end > start, _weekdays(end) - _weekdays(start)).otherwise(F.lit(0)).cast("long")


def tax_type(rate: Column, country: Column, types: dict[str, str] | None = None, default: str = "VAT on Expenses") -> Column:
    """Tax type of a rate label. The characters '.' and '0' leave the label's end, so '20' and '2' are one key."""
    types = TAX_TYPES | (types or {})
    table = F.create_map(*[F.lit(x) for kv in types.items() for x in kv])
    key = F.rtrim(F.rtrim(F.rtrim(strip(rate), F.lit("%")), F.lit(".0")), F.lit("."))
    abroad = F.upper(F.coalesce(country, F.lit("")))
    foreign = (abroad != "") & ~abroad.isin(*HOME) & abroad.isin(*MEMBER_STATES)
    get = lambda k: F.coalesce(F.try_element_at(table, k), F.lit(default))
    return F.when(rate.isNull(), get(F.lit(""))).when(foreign, get(F.lit("EC"))).otherwise(get(key))


def money_text(c: Column) -> Column:
    """Two decimals; currency signs and thousands leave first where needed; other text stays; null is empty."""
    bare = F.trim(F.regexp_replace(c.cast("string"), "[€£,]", ""))
    text = F.coalesce(two_decimals(c.try_cast("double")), two_decimals(bare.try_cast("double")), bare)
    return F.when(F.coalesce(c.cast("string"), F.lit("")) == "", F.lit("")).otherwise(text)


def net_of_gross(gross: Column, rate: Column) -> Column:
    return rounded(gross / (1 + rate / 100))


def gross_of_net(net: Column, rate: Column) -> Column:
    return rounded(net * (1 + rate / 100))


def discounted(total: Column, discount: Column, rate: float = 9.0) -> Column:
    """(total, vat): a total that was lowered by hand, and the VAT in it."""
    lowered = F.array(rounded(total * (1 - discount)))  # as a variable, or its expression would be repeated many times
    return F.get(F.transform(lowered, lambda new: F.struct(new.alias("total"), rounded(new - new / (1 + rate / 100)).alias("vat"))), F.lit(0))


def converted(amount: Column, rate: Column) -> Column:
    return rounded(amount * rate)
