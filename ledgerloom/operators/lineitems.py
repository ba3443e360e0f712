"""Line items: totals, VAT by rate and letter, running balances; rows of tables in HTML."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.money import TABLE_MONEY, first_amount, first_quantity
from ledgerloom.operators.pages import table_rows

# Words of a header row (two at least), and of summary rows.
HEADER_HINTS = ("description", "item", "qty", "quantity", "rate", "unit", "value")
SUMMARY_WORDS = ("subtotal", "sub-total", "vat ", "vat:", "total:", "amount due", "balance due", "grand total", "tax:", "tax ")


def cents(amount: Column) -> Column:
    """An exact amount: sums of it do not depend on their order."""
    return amount.cast("decimal(18,2)")


def vat_by_rate(items: DataFrame) -> DataFrame:
    """Net and VAT (rounded half-even a line) by document and rate; items: (doc_id, rate as a fraction, net)."""
    vat = F.bround(cents(F.col("net")) * F.col("rate").cast("decimal(6,4)"), 2)
    return items.groupBy("doc_id", "rate").agg(F.sum(cents(F.col("net"))).cast("double").alias("net"), F.sum(vat).cast("double").alias("vat"))


def by_letter(items: DataFrame) -> DataFrame:
    """Gross by document and letter, with the rate of the letter's first line; lines without a letter leave."""
    some = items.filter(F.coalesce(F.col("letter"), F.lit("")) != "")
    return some.groupBy("doc_id", "letter").agg(F.sum(cents(F.col("gross"))).cast("double").alias("gross"), F.min_by("rate", "ordinal").alias("rate"))


def totals(items: DataFrame) -> DataFrame:
    return items.groupBy("doc_id").agg(F.sum(cents(F.col("net"))).cast("double").alias("subtotal"), F.count(F.lit(1)).alias("lines"))


def reconcile(documents: DataFrame, items: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """The difference between a document's total and its lines; documents without lines have none."""
    joined = documents.join(totals(items), "doc_id", "left")
    apart = (cents(F.col("total")) - cents(F.col("subtotal"))).cast("double")
    return joined.select("doc_id", "total", "subtotal", apart.alias("difference"), F.coalesce(F.abs(apart) < tolerance, F.lit(False)).alias("reconciled"))


def running_balance(moves: DataFrame, opening: float = 0.0) -> DataFrame:
    """Balance after each move (account, at, id, amount)."""
    order = Window.partitionBy("account").orderBy("at", "id").rowsBetween(Window.unboundedPreceding, 0)
    return moves.withColumn("balance", (F.sum(cents(F.col("amount"))).over(order) + cents(F.lit(opening))).cast("double"))


def table_items(pages: DataFrame) -> DataFrame:
    """(doc_id, row_idx, description, quantity, amount) from pages (doc_id, html), whose markup may be as it is found.

    The header is the first row with two hint words; it and what is above leave, as do summary rows and rows without an
    amount. The amount is the row's last; the description its longest cell without one, the first of equals.
    """
    rows = table_rows(pages, "doc_id")
    hints = lambda r: F.size(F.filter(F.array(*map(F.lit, HEADER_HINTS)), lambda h: F.contains(r["head"], h))) >= 2
    # array_position counts from 1, and 0 is none: so it is also how many rows leave
    rows = rows.withColumn("skip", F.array_position(F.transform("rows", hints), F.lit(True)))
    cells = rows.select("doc_id", "skip", F.posexplode("rows").alias("row_idx", "r")).withColumn("cells", F.filter("r.cells", lambda c: c != ""))
    joined = F.lower(F.array_join("cells", " "))
    summary = F.exists(F.array(*map(F.lit, SUMMARY_WORDS)), lambda w: F.contains(joined, w))
    kept = cells.filter((F.col("row_idx") >= F.col("skip")) & ~summary & (F.size("cells") > 0))
    # as variables of lambdas the amounts are found once a cell
    found = F.transform("cells", lambda c: F.struct(c.alias("c"), first_amount(c, TABLE_MONEY).alias("amount")))
    words = lambda x: F.filter(x, lambda y: F.coalesce(y["amount"], F.lit(0.0)) == 0)
    longest = lambda x: F.array_max(F.transform(words(x), lambda y, i: F.struct(F.length(y["c"]).alias("n"), (-i).alias("at"), y["c"].alias("c"))))
    last = lambda x: F.try_element_at(F.filter(x, lambda y: y["amount"].isNotNull()), F.lit(-1))
    both = F.get(F.transform(F.array(found), lambda x: F.struct(last(x)["amount"].alias("amount"), longest(x)["c"].alias("description"))), F.lit(0))
    out = kept.select("doc_id", "row_idx", F.explode(F.array(both)).alias("x")).select("doc_id", "row_idx", "x.*").filter("amount is not null")
    return out.select("doc_id", F.col("row_idx").cast("long").alias("row_idx"), "description", first_quantity(F.col("description")).alias("quantity"), "amount")


def list_items(pages: DataFrame) -> DataFrame:
    """Title and list entries of each page (page_id, html), in order."""
    first = lambda tag: F.regexp_extract_all("html", F.lit(rf"<{tag}>(.*?)</{tag}>"), F.lit(1))
    bare = lambda x: F.regexp_replace(x, "<[^>]*>", "")
    return pages.select("page_id", bare(F.get(first("title"), F.lit(0))).alias("title"), F.posexplode(F.transform(first("li"), bare)).alias("item_idx", "item"))
