"""A seeded corpus of accounting documents of all template families, as one plan of expressions.

Draws are md5 hashes of (document, line, purpose), so any partition makes the same rows and SQL can state them. Prices,
names and texts are not those of another generator; what is kept is each family's number of items, quantities, VAT rule,
number formats, dates and invariants. Amounts are decimals, rounded half-even to cents a line.

    documents(ids)        (place) -> family, doc_id, vendor identity, dates, numbers
    line_items(docs)      quantity, unit price, rate, letter, net, VAT, gross
    totals(docs, lines)   subtotal, VAT, total by the family's rule; closing balance, printed total, amounts in pounds
    by_rate(lines)        the breakdown of families with several rates; lineitems.by_letter's for letters
    bill_text(...)        the document as plain text; table_html(...) its lines as a table
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.text import derived_id

# Family; fewest and most items; largest quantity; rule of its amounts; rates of its lines; letters of
# its lines; number prefix, date in it, and digits; days until due and per cent with a due date; per cent with an order
# reference. The rule: net prices, gross prices, gross prices with a total lowered by hand, movements of an account.
RULES = (
    ("tradesman_rct", 2, 8, 4, "net", (0.0,), (), "INV-", "yyyyMMdd", 3, (14, 21, 28, 30), 65, 40),
    ("cafe_receipt", 1, 6, 3, "gross", (9.0,), (), "R", None, 5, (), 0, 0),
    ("gp_medical", 1, 1, 1, "net", (0.0,), ("EXEMPT",), "GP-", "yyyyMM", 3, (14,), 50, 0),
    ("vet", 2, 8, 3, "net", (23.0, 4.8, 0.0), (), "INV-", "yyyyMMdd", 3, (21,), 55, 0),
    ("solicitor_loe", 2, 6, 1, "net", (23.0, 0.0), (None, "OUTLAY"), "INV-", "yyyyMMdd", 3, (30,), 65, 30),
    ("restaurant_thermal", 3, 15, 4, "gross", (9.0, 23.0), (), "R", None, 5, (), 0, 0),
    ("supermarket_per_letter_vat", 5, 25, 3, "gross", (23.0, 13.5, 9.0, 4.8, 0.0), ("A", "B", "C", "D", "Z"), "#", None, 6, (), 0, 0),
    ("photographed_receipt", 1, 6, 2, "gross", (9.0,), (), "R", None, 5, (), 0, 0),
    ("handwritten_override", 1, 6, 2, "override", (9.0,), (), "R", None, 5, (), 0, 0),
    ("mixed_rate_retailer", 4, 12, 4, "net", (23.0, 13.5, 9.0), (), "INV-", "yyyyMMdd", 3, (30,), 55, 40),
    ("professional_services", 1, 1, 1, "net", (23.0,), (), "INV-", "yyyyMMdd", 3, (14, 21, 30), 70, 30),
    ("utility_bill", 2, 6, 1, "net", (13.5, 23.0, 0.0), (), "BIL-", "yyyyMMdd", 5, (14,), 100, 0),
    ("bank_statement", 8, 40, 1, "account", (0.0,), ("EXEMPT",), "STMT-", "yyyyMM", 6, (), 0, 0),
    ("construction_supplier", 3, 10, 50, "net", (13.5, 23.0), (), "INV-", "yyyyMMdd", 3, (30,), 65, 50),
    ("credit_note", 1, 4, 3, "net", (23.0,), (), "CN-", "yyyyMMdd", 3, (), 0, 0),
    ("foreign_currency_mixed_vat", 2, 6, 2, "net", (0.0,), ("REVERSE-CHARGE",), "INV-", "yyyyMMdd", 3, (30,), 100, 40),
)
#: Families whose documents show net and VAT by rate.
WITH_BREAKDOWN = ("vet", "mixed_rate_retailer", "construction_supplier")
# The last issue date and how many days before it documents may be; bank codes; letters of retailers' receipts
# and their rates; pounds for a euro, from and to; hundredths by which a total may be lowered.
LAST_DATE, DAYS_BACK = "2026-05-04", 90
BANKS = ("AIBK", "BOFI", "IPBS", "REVO", "NTSB")
LETTER_RATES = {"A": 23.0, "B": 13.5, "C": 9.0, "D": 4.8, "Z": 0.0}
PERCENT_RATES = {"23": 23.0, "13.5": 13.5, "9": 9.0, "4.8": 4.8, "0": 0.0}
RETAILERS = {"tesco": LETTER_RATES, "dunnes": LETTER_RATES, "supervalu": LETTER_RATES, "centra": LETTER_RATES, "spar": LETTER_RATES, "aldi": PERCENT_RATES, "lidl": PERCENT_RATES, "eurogiant": PERCENT_RATES}
FX = (8300, 8900)
LOWERED = (5, 25)

_NAMES = ("ALDER", "BIRCH", "CEDAR", "ELM", "HAZEL", "LAUREL", "MAPLE", "ROWAN")
_KINDS = ("TRADING", "PARTNERS", "WORKS", "GROUP")
_SCHEMA = (
    "family_no int, template_family string, fewest int, most int, most_qty int, rule string, rates array<double>, letters array<string>, "
    "prefix string, date_form string, digits int, due_days array<int>, due_percent int, po_percent int"
)


def draw(n: Column | int, *parts: Column | str) -> Column:
    """A whole number from 0 to n - 1."""
    text = F.concat_ws("|", *[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long") % (n if isinstance(n, Column) else F.lit(n)).cast("long")


def _one_of(options: tuple[str, ...], *parts: Column | str) -> Column:
    return F.get(F.array(*map(F.lit, options)), draw(len(options), *parts).cast("int"))


def _day(c: Column) -> Column:
    return F.date_format(c, "dd/MM/yyyy")


def iban(bank: Column, account: Column) -> Column:
    """An Irish account number with its two check digits; account: fourteen digits."""
    digits = F.lit("")
    for i in range(4):
        digits = F.concat(digits, (F.ascii(F.substring(bank, i + 1, 1)) - F.lit(55)).cast("string"))
    check = F.lit(98).cast("decimal(38,0)") - F.concat(digits, account, F.lit("181400")).cast("decimal(38,0)") % F.lit(97).cast("decimal(38,0)")
    return F.concat(F.lit("IE"), F.lpad(check.cast("string"), 2, "0"), bank, account)


def retailer_rate(retailer: Column, letter: Column) -> Column:
    """The rate behind a retailer's letter; null where either is unknown."""
    each = F.create_map(*[x for name, rates in RETAILERS.items() for x in (F.lit(name), F.create_map(*[F.lit(y) for kv in rates.items() for y in kv]))])
    return F.try_element_at(F.try_element_at(each, F.lower(retailer)), letter)


def documents(ids: DataFrame, master: int = 42) -> DataFrame:
    """A document for each row of ids (place): families go round, draws hang on the document's id alone."""
    spark = ids.sparkSession
    rules = spark.createDataFrame([(i, *[list(x) if isinstance(x, tuple) else x for x in r]) for i, r in enumerate(RULES)], _SCHEMA)
    rows = ids.select(F.col("place").cast("long").alias("place")).withColumn("family_no", F.pmod("place", F.lit(len(RULES))).cast("int"))
    docs = rows.join(F.broadcast(rules), "family_no")  # 16 rows
    docs = docs.withColumn("seed", F.lit(master) * 1000 + F.col("place")).withColumn("doc_id", derived_id(F.col("template_family"), F.lit(master), F.col("place")))
    d = F.col("doc_id")
    issued = F.date_sub(F.to_date(F.lit(LAST_DATE)), draw(DAYS_BACK + 1, d, "issued").cast("int"))
    least = F.when(F.col("digits") == 3, F.when(F.col("prefix") == "INV-", 1).otherwise(100)).otherwise(F.pow(F.lit(10), F.col("digits") - 1).cast("int"))
    serial = least + draw(F.pow(F.lit(10), F.col("digits")).cast("long") - least, d, "serial")
    stamp = F.when(F.col("date_form") == "yyyyMMdd", F.date_format("issued", "yyyyMMdd")).when(F.col("date_form") == "yyyyMM", F.date_format("issued", "yyyyMM"))
    numbered = F.concat("prefix", F.coalesce(F.concat(stamp, F.lit("-")), F.lit("")), F.lpad(serial.cast("string"), F.col("digits"), F.lit("0")))
    days = F.get("due_days", draw(F.greatest(F.size("due_days"), F.lit(1)), d, "days").cast("int"))
    due = F.when(draw(100, d, "due") < F.col("due_percent"), _day(F.date_add("issued", days)))
    po = F.when(draw(100, d, "po") < F.col("po_percent"), F.concat(F.lit("PO/"), (1000 + draw(99000, d, "po number")).cast("string")))
    digits = lambda n, why: F.lpad(draw(10**n, d, why).cast("string"), n, "0")
    bank = _one_of(BANKS, d, "bank")
    before = F.date_sub("issued", (7 + draw(54, d, "referred")).cast("int"))
    end = F.date_sub("issued", (1 + draw(3, d, "period")).cast("int"))
    docs = docs.withColumn("issued", issued)
    return docs.select(
        "place", "seed", d, "template_family", "fewest", "most", "most_qty", "rule", "rates", "letters", "issued",
        F.concat_ws(" ", _one_of(_NAMES, d, "name"), _one_of(_KINDS, d, "kind"), F.lit("LTD")).alias("vendor"),
        F.lit("IE").alias("vendor_country"),
        F.concat(F.lit("IE"), digits(7, "vat"), F.chr(65 + draw(26, d, "vat letter"))).alias("vendor_vat_number"),
        iban(bank, F.concat(digits(7, "branch"), digits(7, "account"))).alias("vendor_iban"),
        F.concat(bank, F.lit("IE2D")).alias("vendor_bic"),
        numbered.alias("invoice_number"), _day(F.col("issued")).alias("invoice_date"),
        F.coalesce(due, F.lit("")).alias("due_date"), F.coalesce(po, F.lit("")).alias("po_reference"),
        F.when(F.col("template_family") == "credit_note", F.concat(F.lit("INV-"), F.date_format(before, "yyyyMMdd"), F.lit("-"), F.lpad((1 + draw(999, d, "refers")).cast("string"), 3, "0"))).otherwise("").alias("references_invoice"),
        F.when(F.col("template_family") == "construction_supplier", F.concat(F.lit("DN-"), F.date_format("issued", "yyyyMMdd"), F.lit("-"), (100 + draw(900, d, "note")).cast("string"))).otherwise("").alias("delivery_note_ref"),
        F.when(F.col("template_family").isin("utility_bill", "bank_statement"), F.concat(_day(F.date_sub(end, 30)), F.lit(" - "), _day(end))).otherwise("").alias("billing_period"),
    )


def line_items(docs: DataFrame) -> DataFrame:
    """The lines of documents(): (doc_id, template_family, rule, ordinal, description, quantity, unit_price, rate, letter, credit, net, vat, gross).

    net + vat = gross on every line; amounts of credit notes are negative. A solicitor's document in which every line is an
    outlay gets a fee as line 0.
    """
    d, i = F.col("doc_id"), F.col("ordinal")
    pick = lambda at: draw(F.size("rates"), d, at, "rate").cast("int")
    n = F.col("fewest") + draw(F.col("most") - F.col("fewest") + 1, d, "items")
    rows = docs.withColumn("ordinals", F.sequence(F.lit(1).cast("long"), n))
    all_outlay = (F.col("template_family") == "solicitor_loe") & F.forall("ordinals", lambda k: pick(k) == 1)
    ordinals = F.when(all_outlay, F.concat(F.array(F.lit(0).cast("long")), F.col("ordinals"))).otherwise(F.col("ordinals"))
    rows = rows.withColumn("ordinal", F.explode(ordinals)).withColumn("at", F.when(i == 0, 0).otherwise(pick(i)))
    price = ((100 + draw(50_000, d, i, "price")) / F.lit(100)).cast("decimal(12,2)")
    sign = F.when(F.col("template_family") == "credit_note", -1).otherwise(1).cast("decimal(1,0)")
    rows = rows.withColumn("rate", F.get("rates", "at")).withColumn("quantity", 1 + draw(F.col("most_qty"), d, i, "quantity")).withColumn("unit_price", price)
    rows = rows.withColumn("amount", (F.col("unit_price") * F.col("quantity").cast("decimal(4,0)") * sign).cast("decimal(14,2)")).withColumn("r", F.col("rate").cast("decimal(6,2)"))
    inclusive = F.col("rule").isin("gross", "override")
    net = F.when(inclusive, F.bround((F.col("amount") * 100).cast("decimal(18,2)") / (100 + F.col("r")), 2)).otherwise(F.col("amount")).cast("decimal(14,2)")
    vat = F.when(inclusive, F.col("amount") - F.col("net")).otherwise(F.bround(F.col("amount") * F.col("r") / F.lit(100).cast("decimal(3,0)"), 2)).cast("decimal(14,2)")
    rows = rows.withColumn("net", net).withColumn("vat", vat).withColumn("gross", (F.col("net") + F.col("vat")).cast("decimal(14,2)"))
    letter = F.when(F.size("letters") == F.size("rates"), F.get("letters", "at")).otherwise(F.get("letters", F.lit(0)))
    said = F.concat(_one_of(("Alpha", "Beta", "Gamma", "Delta", "Sigma"), d, i, "word"), F.lit(" service"))
    return rows.select("doc_id", "template_family", "rule", "ordinal", said.alias("description"), "quantity", "unit_price", "rate", letter.alias("letter"), (draw(2, d, i, "credit") == 1).alias("credit"), "net", "vat", "gross")


def totals(docs: DataFrame, lines: DataFrame) -> DataFrame:
    """documents() with subtotal, vat and total by the family's rule, opening and closing balance, printed total, and pounds.

    Sums of the lines, but: a receipt's total that was lowered by hand is the lowered one, with the VAT in it; an account's total
    is its closing balance, or 0 below it.
    """
    cents = lambda c: c.cast("decimal(18,2)")
    summed = lines.groupBy("doc_id").agg(F.sum("net").alias("nets"), F.sum("vat").alias("vats"), F.sum("gross").alias("grosses"), F.sum(F.when(F.col("credit"), F.col("gross")).otherwise(-F.col("gross"))).alias("moved"), F.count(F.lit(1)).alias("n_lines"))
    d, rule = F.col("doc_id"), F.col("rule")
    rows = docs.join(summed, "doc_id").withColumn("opening_balance", F.when(rule == "account", cents((50_000 + draw(1_150_000, d, "opening")) / F.lit(100))))
    rows = rows.withColumn("closing_balance", cents(F.col("opening_balance") + F.col("moved"))).withColumn("printed_total", F.when(rule == "override", cents(F.col("grosses"))))
    lowered = (10_000 - 100 * LOWERED[0] - draw(100 * (LOWERED[1] - LOWERED[0]) + 1, d, "lowered")).cast("decimal(6,0)") / F.lit(10_000).cast("decimal(6,0)")
    total = F.when(rule == "account", F.greatest(F.col("closing_balance"), cents(F.lit(0)))).when(rule == "override", F.bround(F.col("printed_total") * lowered, 2)).otherwise(F.col("grosses"))
    rows = rows.withColumn("total", cents(total))
    vat = F.when(rule == "account", F.lit(0)).when(rule == "override", F.bround(F.col("total") * F.lit(9).cast("decimal(3,0)") / F.lit(109).cast("decimal(3,0)"), 2)).otherwise(F.col("vats"))
    rows = rows.withColumn("vat", cents(vat)).withColumn("subtotal", cents(F.col("total") - F.col("vat")))
    rate = F.when(F.col("template_family") == "foreign_currency_mixed_vat", ((FX[0] + draw(FX[1] - FX[0] + 1, d, "fx")) / F.lit(10_000)).cast("decimal(6,4)"))
    return rows.withColumn("eur_to_gbp", rate).withColumn("total_gbp", cents(F.bround(F.col("total") * F.col("eur_to_gbp"), 2))).drop("moved")


def by_rate(lines: DataFrame) -> DataFrame:
    """(doc_id, rate, net, vat) of the families that show it."""
    return lines.filter(F.col("template_family").isin(*WITH_BREAKDOWN)).groupBy("doc_id", "rate").agg(F.sum("net").alias("net"), F.sum("vat").alias("vat"))


def bill_text(whole: DataFrame) -> DataFrame:
    """(doc_id, text) of totals() rows: heading, number, date, amounts, as a text layer would have them."""
    euro = lambda c: F.concat(F.lit("EUR "), F.format_number(c, 2))
    said = F.concat_ws(
        "\n", F.concat("vendor", F.lit(" INVOICE")), F.concat(F.lit("Invoice No: "), F.col("invoice_number")), F.concat(F.lit("VAT No. "), F.col("vendor_vat_number")),
        F.concat(F.lit("Pay to "), F.col("vendor_iban")), F.col("invoice_date"), F.concat(F.lit("Subtotal "), euro(F.col("subtotal"))), F.concat(F.lit("VAT: "), euro(F.col("vat"))),
        F.when(F.col("place") % 2 == 0, F.concat(F.lit("Total: "), euro(F.col("total")))).otherwise(F.concat(F.lit("Total:\n"), euro(F.col("total")))),
    )
    return whole.select("doc_id", said.alias("text"))


def table_html(lines: DataFrame) -> DataFrame:
    """(doc_id, html): the lines of a document as a table with a header and a total row."""
    cell = lambda *c: F.concat(*[F.concat(F.lit("<td>"), x, F.lit("</td>")) for x in c])
    row = F.concat(F.lit("<tr>"), cell(F.concat(F.col("quantity").cast("string"), F.lit(" x "), F.col("description")), F.lit(""), F.concat(F.lit("EUR "), F.format_number("gross", 2))), F.lit("</tr>"))
    made = lines.groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ordinal", row.alias("row")))), lambda x: x["row"]), "").alias("rows"))
    head = "<table><tr><td>Supplied by</td></tr><tr><td>Description</td><td>Qty</td><td>Value</td></tr>"
    return made.select("doc_id", F.concat(F.lit(head), F.col("rows"), F.lit("<tr><td>Amount due</td><td>1.00</td></tr></table>")).alias("html"))


def families_hold(rules: tuple = RULES) -> None:
    """Sixteen families with names of their own, or an error."""
    names = [r[0] for r in rules]
    if len(names) != 16 or len(set(names)) != 16:
        raise ValueError(f"expected 16 distinct families, found {len(set(names))} in {len(names)}")
