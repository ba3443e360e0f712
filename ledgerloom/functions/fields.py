"""Header fields read from a document's text: vendor, total, VAT, date. One expression each, no Python on rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions.money import MONEY, all_amounts, first_amount
from ledgerloom.functions.text import lines, strip

FIELDS = ("vendor", "total", "vat", "date")
HEAD_LINES = 8

# Document kinds at the end of a heading, words that no vendor line holds, and shapes of vendor lines.
KIND = (
    r"\s+(?:(?:INTERNATIONAL|EXPORT|DOMESTIC|COMMERCIAL|PROFORMA|PRO-FORMA)\s+)?"
    r"(RECEIPT|INVOICE|STATEMENT|CREDIT\s+NOTE|LETTER\s+OF\s+ENGAGEMENT|VAT\s+INVOICE|TAX\s+INVOICE|FEE\s+NOTE|"
    r"UTILITY\s+BILL|DELIVERY\s+NOTE|BILL|REPORT)\s*$"
)
NEVER_VENDOR = (
    "invoice no", "invoice number", "total", "vat reg", "vat exempt", "page", "date", "due date", "subtotal", "amount due", "balance", "tax point",
    "received", "services rendered", "items", "description", "qty", "unit price", "payment details", "billing period", "transaction",
    "delivery note ref", "fees",
)
CAPITALS = r"^[A-Z][A-Z0-9 &.,'-]{3,60}$"
MIXED = r"^[A-Z][A-Za-z0-9 &.,'-]{3,80}$"
# Shapes of dates, of amounts that are due, and of lines about VAT and about VAT numbers.
DATE = r"\b(\d{1,2}[/-]\d{1,2}[/-]\d{2,4})\b"
DUE = r"(?i)(?:amount\s+due|grand\s+total)[:\s]*\n?\s*(?:€|EUR)?\s*([\d,]+\.\d{2})"
VAT_LINE, VAT_NUMBER_LINE = r"(?i)\bvat\b", r"(?i)\bvat\s+(no\.?|IE\d)"


def vendor(text: Column) -> Column:
    """The first heading in capitals, or else in mixed case, that no accounting word spoils."""
    heads = F.transform(F.slice(lines(text), 1, HEAD_LINES), lambda x: strip(F.regexp_replace(strip(x), KIND, "")))
    fits = lambda x: F.length(x).between(4, 80) & ~F.exists(F.array(*map(F.lit, NEVER_VENDOR)), lambda w: F.contains(F.lower(x), w))
    of = lambda shape: F.get(F.filter(heads, lambda x: F.regexp_like(x, F.lit(shape)) & fits(x)), F.lit(0))
    return F.coalesce(of(CAPITALS), of(MIXED))


def total(text: Column) -> Column:
    """The amount on a total line or on the line after it, else what is due, else the largest amount."""
    rows = lines(text)
    after = F.concat(F.slice(rows, 2, F.greatest(F.size(rows) - 1, F.lit(0))), F.array(F.lit("")))
    both = F.zip_with(rows, after, lambda x, y: F.struct(x.alias("x"), F.coalesce(first_amount(x), first_amount(y)).alias("v")))
    is_total = lambda r: F.regexp_like(F.lower(r["x"]), F.lit(r"\btotal\b")) & ~F.contains(F.lower(r["x"]), F.lit("subtotal")) & r["v"].isNotNull()
    on_line = F.get(F.filter(both, is_total), F.lit(0))["v"]
    due = F.replace(F.nullif(F.regexp_extract(text, DUE, 1), F.lit("")), F.lit(","), F.lit("")).try_cast("double")
    return F.coalesce(on_line, due, F.array_max(all_amounts(text)))


def vat(text: Column) -> Column:
    """The amount on the first VAT line that is not about the VAT number."""
    good = lambda x: F.regexp_like(x, F.lit(VAT_LINE)) & ~F.regexp_like(x, F.lit(VAT_NUMBER_LINE)) & F.regexp_like(x, F.lit(MONEY))
    return first_amount(F.get(F.filter(lines(text), good), F.lit(0)))


def date(text: Column) -> Column:
    return F.nullif(F.regexp_extract(text, DATE, 1), F.lit(""))
