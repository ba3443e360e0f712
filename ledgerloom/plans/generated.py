"""Queries over documents that are generated for the rows of the documents table, and the SQL that gives the same rows.

The SQL states the families' rules itself, in whole cents, and what a reading of a generated text must find, so neither the
generator nor the readers are their own oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import fields, money, text
from ledgerloom.operators import extraction, gate, governance, lineitems, sampling, scoring
from ledgerloom.plans import generator, job
from ledgerloom.plans.registry import query, table
from ledgerloom.sources.io import merged_config


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return generator.documents(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("place")).distinct())


def _whole(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    docs = _docs(spark, sf_dir)
    lines = generator.line_items(docs)
    return generator.totals(docs, lines), lines


def _doubles(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c, kind in df.dtypes if kind.startswith("decimal")})


def _draw(n: str | int, *parts: str) -> str:
    return f"(CAST('0x' || substr(md5(concat_ws('|', {', '.join(parts)})), 1, 8) AS BIGINT) % {n})"


def _even(n: str, d: str) -> str:
    """n / d in whole numbers, half-even, for n of any sign."""
    q = f"(abs({n}) // ({d}))"
    r = f"(2 * (abs({n}) % ({d})))"
    return f"(sign({n}) * ({q} + CASE WHEN {r} > ({d}) OR ({r} = ({d}) AND {q} % 2 = 1) THEN 1 ELSE 0 END))::BIGINT"


def _sql(select: str) -> str:
    """select over g (documents), l (lines in cents) and t (totals in cents)."""
    pick = lambda i: _draw("len(rates)", "id", i, "'rate'")
    return f"""
WITH r(no, family, fewest, most, qty, kind, rates, letters, prefix, form, digits, days, due_percent, po_percent) AS (VALUES
  (0, 'tradesman_rct', 2, 8, 4, 'net', [0], NULL, 'INV-', 'day', 3, [14, 21, 28, 30], 65, 40), (1, 'cafe_receipt', 1, 6, 3, 'gross', [90], NULL, 'R', '', 5, NULL, 0, 0),
  (2, 'gp_medical', 1, 1, 1, 'net', [0], ['EXEMPT'], 'GP-', 'month', 3, [14], 50, 0), (3, 'vet', 2, 8, 3, 'net', [230, 48, 0], NULL, 'INV-', 'day', 3, [21], 55, 0),
  (4, 'solicitor_loe', 2, 6, 1, 'net', [230, 0], [NULL, 'OUTLAY'], 'INV-', 'day', 3, [30], 65, 30), (5, 'restaurant_thermal', 3, 15, 4, 'gross', [90, 230], NULL, 'R', '', 5, NULL, 0, 0),
  (6, 'supermarket_per_letter_vat', 5, 25, 3, 'gross', [230, 135, 90, 48, 0], ['A', 'B', 'C', 'D', 'Z'], '#', '', 6, NULL, 0, 0), (7, 'photographed_receipt', 1, 6, 2, 'gross', [90], NULL, 'R', '', 5, NULL, 0, 0),
  (8, 'handwritten_override', 1, 6, 2, 'override', [90], NULL, 'R', '', 5, NULL, 0, 0), (9, 'mixed_rate_retailer', 4, 12, 4, 'net', [230, 135, 90], NULL, 'INV-', 'day', 3, [30], 55, 40),
  (10, 'professional_services', 1, 1, 1, 'net', [230], NULL, 'INV-', 'day', 3, [14, 21, 30], 70, 30), (11, 'utility_bill', 2, 6, 1, 'net', [135, 230, 0], NULL, 'BIL-', 'day', 5, [14], 100, 0),
  (12, 'bank_statement', 8, 40, 1, 'account', [0], ['EXEMPT'], 'STMT-', 'month', 6, NULL, 0, 0), (13, 'construction_supplier', 3, 10, 50, 'net', [135, 230], NULL, 'INV-', 'day', 3, [30], 65, 50),
  (14, 'credit_note', 1, 4, 3, 'net', [230], NULL, 'CN-', 'day', 3, NULL, 0, 0), (15, 'foreign_currency_mixed_vat', 2, 6, 2, 'net', [0], ['REVERSE-CHARGE'], 'INV-', 'day', 3, [30], 100, 40)),
p AS (SELECT DISTINCT doc_id AS place FROM documents),
g AS (SELECT *, DATE '2026-05-04' - CAST({_draw(91, "id", "'issued'")} AS INT) AS issued,
    ['ALDER', 'BIRCH', 'CEDAR', 'ELM', 'HAZEL', 'LAUREL', 'MAPLE', 'ROWAN'][1 + {_draw(8, "id", "'name'")}] || ' ' || ['TRADING', 'PARTNERS', 'WORKS', 'GROUP'][1 + {_draw(4, "id", "'kind'")}] || ' LTD' AS vendor,
    ['AIBK', 'BOFI', 'IPBS', 'REVO', 'NTSB'][1 + {_draw(5, "id", "'bank'")}] AS bank,
    lpad(CAST({_draw(10**7, "id", "'branch'")} AS VARCHAR), 7, '0') || lpad(CAST({_draw(10**7, "id", "'account'")} AS VARCHAR), 7, '0') AS account,
    'IE' || lpad(CAST({_draw(10**7, "id", "'vat'")} AS VARCHAR), 7, '0') || chr(CAST(65 + {_draw(26, "id", "'vat letter'")} AS INT)) AS vat_number
  FROM (SELECT *, 'synth-' || substr(sha256(family || '|42|' || CAST(place AS VARCHAR)), 1, 12) AS id FROM p JOIN r ON place % 16 = no)),
n AS (SELECT *, unnest(range(1, 1 + fewest + {_draw("(most - fewest + 1)", "id", "'items'")})) AS i FROM g),
k AS (SELECT *, 1 + {pick("i")} AS pl FROM n),
o AS (SELECT * FROM k UNION ALL (SELECT * REPLACE (0 AS i, 1 AS pl) FROM k WHERE family = 'solicitor_loe' QUALIFY min(pl) OVER (PARTITION BY id) = 2 AND i = 1)),
a AS (SELECT *, rates[pl] AS rate, 1 + {_draw("qty", "id", "i", "'quantity'")} AS quantity, 100 + {_draw(50000, "id", "i", "'price'")} AS price FROM o),
b AS (SELECT *, quantity * price * CASE family WHEN 'credit_note' THEN -1 ELSE 1 END AS amount FROM a),
c AS (SELECT *, CASE WHEN kind IN ('gross', 'override') THEN {_even("amount * 1000", "1000 + rate")} ELSE amount END AS net FROM b),
l AS (SELECT *, CASE WHEN kind IN ('gross', 'override') THEN amount - net ELSE {_even("amount * rate", "1000")} END AS vat FROM c),
s AS (SELECT id, count(*) AS n_lines, sum(net)::BIGINT AS nets, sum(vat)::BIGINT AS vats, sum(net + vat)::BIGINT AS grosses, sum(CASE WHEN {_draw(2, "id", "i", "'credit'")} = 1 THEN net + vat ELSE -net - vat END)::BIGINT AS moved FROM l GROUP BY 1),
u AS (SELECT g.*, n_lines, vats, grosses, moved + 50000 + {_draw(1150000, "id", "'opening'")} AS closing, {_even(f"grosses * (9500 - {_draw(2001, 'id', chr(39) + 'lowered' + chr(39))})", "10000")} AS lowered FROM g JOIN s USING (id)),
v AS (SELECT *, CASE kind WHEN 'account' THEN greatest(closing, 0) WHEN 'override' THEN lowered ELSE grosses END AS total FROM u),
t AS (SELECT *, CASE kind WHEN 'account' THEN 0 WHEN 'override' THEN {_even("total * 9", "109")} ELSE vats END AS vat FROM v)
{select}
"""


_LETTER = "CASE len(letters) WHEN len(rates) THEN letters[pl] ELSE letters[1] END"


@query(_sql(f"SELECT id AS doc_id, family AS template_family, i::BIGINT AS ordinal, quantity::BIGINT AS quantity, price::DOUBLE / 100 AS unit_price, rate::DOUBLE / 10 AS rate, {_LETTER} AS letter, net::DOUBLE / 100 AS net, vat::DOUBLE / 100 AS vat, (net + vat)::DOUBLE / 100 AS gross FROM l"))
def generated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The line items of generated documents."""
    return _doubles(generator.line_items(_docs(spark, sf_dir))).drop("description", "credit", "rule")


@query(_sql(f"""
SELECT id AS doc_id, family AS template_family, n_lines::BIGINT AS n_lines, (total - vat)::DOUBLE / 100 AS subtotal, vat::DOUBLE / 100 AS vat, total::DOUBLE / 100 AS total,
  CASE kind WHEN 'account' THEN closing::DOUBLE / 100 END AS closing_balance, CASE kind WHEN 'override' THEN grosses::DOUBLE / 100 END AS printed_total,
  CASE no WHEN 15 THEN (8300 + {_draw(601, "id", "'fx'")})::DOUBLE / 10000 END AS eur_to_gbp, CASE no WHEN 15 THEN {_even(f"total * (8300 + {_draw(601, 'id', chr(39) + 'fx' + chr(39))})", "10000")}::DOUBLE / 100 END AS total_gbp FROM t
"""))
def generated_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The totals of generated documents by their families' rules."""
    names = ("doc_id", "template_family", "n_lines", "subtotal", "vat", "total", "closing_balance", "printed_total", "eur_to_gbp", "total_gbp")
    return _doubles(_whole(spark, sf_dir)[0].select(*names))


_SERIAL = f"(CASE WHEN digits > 3 OR prefix <> 'INV-' THEN (10 ** (digits - 1))::BIGINT ELSE 1 END + {_draw('((10 ** digits)::BIGINT - CASE WHEN digits > 3 OR prefix <> ' + chr(39) + 'INV-' + chr(39) + ' THEN (10 ** (digits - 1))::BIGINT ELSE 1 END)', 'id', chr(39) + 'serial' + chr(39))})"
_CHECK = f"(98 - CAST({' || '.join(f'CAST(ascii(substr(bank, {i}, 1)) - 55 AS VARCHAR)' for i in (1, 2, 3, 4))} || account || '181400' AS HUGEINT) % 97)"


@query(_sql(f"""
SELECT id AS doc_id, vendor, vat_number AS vendor_vat_number, 'IE' || lpad(CAST({_CHECK} AS VARCHAR), 2, '0') || bank || account AS vendor_iban, bank || 'IE2D' AS vendor_bic,
  prefix || CASE form WHEN 'day' THEN strftime(issued, '%Y%m%d') || '-' WHEN 'month' THEN strftime(issued, '%Y%m') || '-' ELSE '' END || lpad(CAST({_SERIAL} AS VARCHAR), digits, '0') AS invoice_number,
  strftime(issued, '%d/%m/%Y') AS invoice_date,
  coalesce(CASE WHEN {_draw(100, "id", "'due'")} < due_percent THEN strftime(issued + CAST(days[1 + {_draw("coalesce(len(days), 1)", "id", "'days'")}] AS INT), '%d/%m/%Y') END, '') AS due_date,
  CASE WHEN {_draw(100, "id", "'po'")} < po_percent THEN 'PO/' || CAST(1000 + {_draw(99000, "id", "'po number'")} AS VARCHAR) ELSE '' END AS po_reference,
  CASE no WHEN 14 THEN 'INV-' || strftime(issued - CAST(7 + {_draw(54, "id", "'referred'")} AS INT), '%Y%m%d') || '-' || lpad(CAST(1 + {_draw(999, "id", "'refers'")} AS VARCHAR), 3, '0') ELSE '' END AS references_invoice,
  CASE no WHEN 13 THEN 'DN-' || strftime(issued, '%Y%m%d') || '-' || CAST(100 + {_draw(900, "id", "'note'")} AS VARCHAR) ELSE '' END AS delivery_note_ref,
  CASE WHEN no IN (11, 12) THEN strftime(issued - CAST(31 + {_draw(3, "id", "'period'")} AS INT), '%d/%m/%Y') || ' - ' || strftime(issued - CAST(1 + {_draw(3, "id", "'period'")} AS INT), '%d/%m/%Y') ELSE '' END AS billing_period FROM g
"""))
def generated_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Identities, numbers and dates of generated documents."""
    return _docs(spark, sf_dir).select("doc_id", "vendor", "vendor_vat_number", "vendor_iban", "vendor_bic", "invoice_number", "invoice_date", "due_date", "po_reference", "references_invoice", "delivery_note_ref", "billing_period")


@query(_sql("SELECT id AS doc_id, rate::DOUBLE / 10 AS rate, sum(net)::DOUBLE / 100 AS net, sum(vat)::DOUBLE / 100 AS vat FROM l WHERE no IN (3, 9, 13) GROUP BY 1, 2"))
def generated_breakdowns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _doubles(generator.by_rate(generator.line_items(_docs(spark, sf_dir))))


@query(_sql(f"SELECT id AS doc_id, {_LETTER} AS letter, sum(net + vat)::DOUBLE / 100 AS gross, min(CASE {_LETTER} WHEN 'A' THEN 23.0 WHEN 'B' THEN 13.5 WHEN 'C' THEN 9.0 WHEN 'D' THEN 4.8 ELSE 0.0 END)::DOUBLE AS rate FROM l WHERE {_LETTER} IS NOT NULL GROUP BY 1, 2"))
def generated_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gross by letter; the rate is looked up where the letter is a supermarket's, and is the line's otherwise."""
    found = lineitems.by_letter(generator.line_items(_docs(spark, sf_dir)))
    return found.select("doc_id", "letter", "gross", F.coalesce(generator.retailer_rate(F.lit("Tesco"), F.col("letter")), "rate").alias("rate"))


@query(_sql("SELECT family AS template_family, count(*)::BIGINT AS n, count(*)::BIGINT AS adds_up, CASE WHEN no IN (8, 12) THEN count(*) FILTER (s.nets = t.total - t.vat) ELSE count(*) END::BIGINT AS lines_add_up FROM t JOIN s USING (id) GROUP BY no, family"))
def generated_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By family: documents, those with subtotal + VAT = total, and those whose lines sum to the subtotal (all but in two families)."""
    rows = _whole(spark, sf_dir)[0]
    adds, lines_add = F.col("subtotal") + F.col("vat") == F.col("total"), F.col("nets") == F.col("subtotal")
    return rows.groupBy("template_family").agg(F.count(F.lit(1)).alias("n"), F.count_if(adds).alias("adds_up"), F.count_if(lines_add).alias("lines_add_up"))


@query(_sql("SELECT id AS doc_id, vendor, CASE WHEN no <> 14 THEN total::DOUBLE / 100 END AS total, CASE WHEN no <> 14 THEN vat::DOUBLE / 100 END AS vat, strftime(issued, '%d/%m/%Y') AS date FROM t"))
def read_generated_bills(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fields that are read from the texts of generated documents. Amounts of credit notes have a sign that no pattern takes."""
    t = F.col("text")
    return generator.bill_text(_whole(spark, sf_dir)[0]).select("doc_id", fields.vendor(t).alias("vendor"), fields.total(t).alias("total"), fields.vat(t).alias("vat"), fields.date(t).alias("date"))


@query(_sql(f"SELECT id AS doc_id, vat_number, 'IE' || lpad(CAST({_CHECK} AS VARCHAR), 2, '0') || bank || account AS iban FROM g"))
def read_generated_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The VAT and account numbers that are read from the texts of generated documents."""
    return generator.bill_text(_whole(spark, sf_dir)[0]).select("doc_id", extraction.numbers(F.col("text")).alias("n")).select("doc_id", "n.*")


@query(_sql(f"""
SELECT id AS doc_id, (1 + row_number() OVER (PARTITION BY id ORDER BY i))::BIGINT AS row_idx, CAST(quantity AS VARCHAR) || ' x ' || ['Alpha', 'Beta', 'Gamma', 'Delta', 'Sigma'][1 + {_draw(5, "id", "i", "'word'")}] || ' service' AS description,
  quantity::DOUBLE AS quantity, abs(net + vat)::DOUBLE / 100 AS amount FROM l
"""))
def read_generated_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The line items that are read from the tables of generated documents."""
    return lineitems.table_items(generator.table_html(generator.line_items(_docs(spark, sf_dir))))


_RATIO = "(vat::DOUBLE / 100) / (total::DOUBLE / 100)"
_NEAR = f"({' OR '.join(f'abs({_RATIO} - {r}::DOUBLE) < 0.005' for r in ('0.0', '0.048 / 1.048', '0.09 / 1.09', '0.135 / 1.135', '0.23 / 1.23'))})"


@query(_sql(f"""
SELECT id AS doc_id, total <= 0 OR {_NEAR} AS plausible, total > 0 AND NOT {_NEAR} AS implausible_ratio, vat > total AS vat_exceeds_total FROM t
"""))
def generated_cross_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cross-field checks of correct documents: those with several rates and credit notes are flagged, as the rule has it."""
    rows = _doubles(_whole(spark, sf_dir)[0].select("doc_id", "vat", "total"))
    return rows.select("doc_id", gate.cross_field(F.col("vat"), F.col("total")).alias("c")).select("doc_id", "c.plausible", "c.implausible_ratio", "c.vat_exceeds_total")


@query(_sql("""
SELECT id AS doc_id, f AS field_id, CASE f WHEN 'total' THEN total BETWEEN 0 AND 100000000 WHEN 'vat' THEN vat BETWEEN 0 AND 100000000 ELSE true END AS ok FROM t CROSS JOIN (VALUES ('vendor'), ('total'), ('vat'), ('date')) x(f)
"""))
def generated_schema_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every critical field of every generated document against the rules for its kind."""
    rows = _whole(spark, sf_dir)[0].select("doc_id", "vendor", F.col("total").cast("string").alias("total"), F.col("vat").cast("string").alias("vat"), F.col("invoice_date").alias("date"))
    long = rows.unpivot(["doc_id"], ["vendor", "total", "vat", "date"], "field_id", "value")
    return long.select("doc_id", "field_id", gate.field_valid(F.col("field_id"), F.col("value"))["ok"].alias("ok"))


_FORMS = ("%-d/%-m/%Y", "%Y-%m-%d", "%d-%m-%Y", "%-d.%-m.%Y", "%Y/%m/%d", "%-d %b %Y", "%d %B %Y", "%d/%m/%y", "%d-%m-%y")


@query(_sql(f"""
SELECT id AS doc_id, CASE WHEN w < 7 THEN strftime(issued, '%d/%m/%Y') ELSE CASE w {' '.join(f"WHEN {i} THEN strftime(issued, '{f}')" for i, f in enumerate(_FORMS))} END END AS formatted,
  CASE WHEN w < 7 THEN strftime(issued + 30, '%d/%m/%Y') ELSE '' END AS due FROM (SELECT *, {_draw(9, "id", "'form'")} AS w FROM g)
"""))
def generated_due_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Issue dates in nine forms, the last two with years of two digits, which stay as they are and have no due date."""
    forms = ("d/M/yyyy", "yyyy-MM-dd", "dd-MM-yyyy", "d.M.yyyy", "yyyy/MM/dd", "d MMM yyyy", "dd MMMM yyyy", "dd/MM/yy", "dd-MM-yy")
    w = generator.draw(9, F.col("doc_id"), "form")
    raw = F.coalesce(*[F.when(w == i, F.date_format("issued", f)) for i, f in enumerate(forms)])
    formatted = money.format_date(raw)
    return _docs(spark, sf_dir).select("doc_id", formatted.alias("formatted"), money.due_date(formatted, 30).alias("due"))


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label documents of the generated corpus; one in three has one of thirty faults."""
    whole, lines = _whole(spark, sf_dir)
    rates = lines.groupBy("doc_id").agg(F.collect_set("rate").alias("rates"))
    d = F.col("doc_id")
    fault = generator.draw(90, d, "fault")
    bad = lambda k, c, wrong: F.when(F.col("fault") == k, wrong).otherwise(c)
    none = lambda kind: F.lit(None).cast(kind)
    rows = _doubles(whole.drop("rates").join(rates, "doc_id")).withColumn("fault", fault)
    return rows.select(
        "fault", "place",
        bad(0, d, F.concat(d, F.lit("x"))).alias("doc_id"),
        bad(1, F.lit("a.pdf"), none("string")).alias("source_path"), bad(2, F.lit("0.4"), F.lit("0.5")).alias("schema_version"), bad(3, F.lit("0.4.2-step0.1"), F.lit("0.4.2")).alias("contracts_version"),
        bad(4, F.col("template_family"), F.lit("zoo")).alias("template_family"), bad(5, F.lit("clean"), F.lit("dirty")).alias("corruption_bucket"),
        F.struct(
            bad(6, F.col("vendor"), none("string")).alias("vendor"), bad(7, F.col("total"), none("double")).alias("total"), bad(8, F.col("vat"), none("double")).alias("vat"),
            bad(9, F.col("invoice_date"), F.lit("1/2/2026")).alias("date"), bad(10, F.col("subtotal"), none("double")).alias("subtotal"), bad(11, F.col("vendor_country"), F.lit("Ireland")).alias("vendor_country"),
        ).alias("fields"),
        bad(12, F.col("rates"), F.array(F.lit(7.0))).alias("rates"),
        F.struct(
            bad(13, F.lit("digital_native"), F.lit("fax")).alias("original_form"), bad(14, F.lit("engine"), none("string")).alias("source_engine"), bad(15, F.sha2(d, 256), F.lit("abc")).alias("file_sha256"),
            bad(16, F.lit(10).cast("long"), F.lit(-1).cast("long")).alias("file_size_bytes"), bad(17, F.lit("2026-05-04T00:00:00Z"), none("string")).alias("ingest_timestamp_utc"), bad(18, F.lit(1), F.lit(0)).alias("page_count"),
            bad(19, F.lit("original-form-preserved"), F.lit("no")).alias("vatca_attestation"),
        ).alias("provenance"),
        bad(20, F.col("seed"), none("long")).alias("synthetic_seed"), bad(21, F.lit("pending"), F.lit("head")).alias("synthetic_generator_commit"), bad(22, F.lit("Apache-2.0"), F.lit("MIT")).alias("license_tag"),
    )


@query(_sql(f"""
SELECT place, ['doc_id', 'source_path', 'schema_version', 'contracts_version', 'template_family', 'corruption_bucket', 'fields.vendor', 'fields.total', 'fields.vat', 'fields.date', 'fields.subtotal',
  'fields.vendor_country', 'line_items.vat_rate_pct', 'provenance.original_form', 'provenance.source_engine', 'provenance.file_sha256', 'provenance.file_size_bytes', 'provenance.ingest_timestamp_utc',
  'provenance.page_count', 'provenance.vatca_attestation', 'synthetic_seed', 'synthetic_generator_commit', 'license_tag'][1 + {_draw(90, "id", "'fault'")}] AS rule FROM g WHERE {_draw(90, "id", "'fault'")} < 23
"""))
def label_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rules that generated labels with planted faults break."""
    labels = _labels(spark, sf_dir)
    return labels.select("place", F.explode(governance.broken_rules()).alias("rule"))


# --- the run from texts to scores ------------------------------------------------------------------------------------------


def _run(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Two engines read the generated bills; every ninth time the second one takes the first digit of the total for a 9."""
    whole = _whole(spark, sf_dir)[0]
    bills = generator.bill_text(whole).join(whole.select("doc_id", "place"), "doc_id")
    misread = F.when(F.col("place") % 9 == 0, F.regexp_replace("text", r"Total:(\s+)EUR \d", "Total:$1EUR 9")).otherwise(F.col("text"))
    engines = F.array(F.struct(F.lit("e1").alias("engine"), F.lit(1).alias("ordinal"), F.col("text").alias("text")), F.struct(F.lit("e2").alias("engine"), F.lit(2).alias("ordinal"), misread.alias("text")))
    texts = bills.select("doc_id", F.explode(engines).alias("x")).select("doc_id", "x.*")
    sure = texts.select("doc_id", "engine", F.lit(1.0).alias("confidence"))
    labels = extraction.label_documents(whole.withColumnRenamed("vendor", "vendor_name"))
    truth = scoring.truth_rows(labels)
    sets = whole.select("doc_id", F.col("template_family").alias("set_slug"), F.lit(0.5).alias("elapsed_s"))
    return job.baseline(texts, sure, truth, sets)


_MISREAD = "(place % 9 = 0 AND no <> 14 AND left(CAST(total // 100 AS VARCHAR), 1) <> '9')"
_VALUES = "(no <> 14)"
_BOUNCES = f"(total > 0 AND NOT {_NEAR})"
_PASSES = f"({_VALUES} AND NOT {_MISREAD} AND total <= 100000000 AND NOT {_BOUNCES} AND NOT vat > total)"


@query(_sql(f"""
SELECT id AS doc_id, {_PASSES} AS gate_passed,
  nullif(concat_ws(' | ', CASE WHEN no = 14 THEN 'below-threshold: total=0.00, vat=0.00' WHEN {_MISREAD} THEN 'below-threshold: total=0.50' END,
    CASE WHEN no <> 14 AND {_BOUNCES} THEN 'cross-field: vat/total ratio ' || printf('%.4f', {_RATIO}) || ' not within ±0.005 of IE rates (0%, 4.8%, 9%, 13.5%, 23%)' END), '') AS bounce_reason FROM t
"""))
def extraction_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which generated documents pass the gate after two engines have read them, and why the others do not."""
    return _run(spark, sf_dir)[2].select("doc_id", "gate_passed", "bounce_reason")


@query(_sql(f"""
SELECT *, passed::DOUBLE / n_docs AS straight_through_rate, bounced::DOUBLE / n_docs AS bounce_rate, 0.0::DOUBLE AS silent_failure_rate, 0.5::DOUBLE AS mean_s
FROM (SELECT family AS set_slug, count(*)::BIGINT AS n_docs, count(*) FILTER ({_PASSES})::BIGINT AS passed, count(*) FILTER (NOT {_PASSES})::BIGINT AS bounced, 0::BIGINT AS silent_failures, 0.5::DOUBLE * count(*) AS total_time_s FROM t GROUP BY 1)
"""))
def extraction_scorecard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scorecard of the run by family: nothing that passes is wrong."""
    return _run(spark, sf_dir)[0]


@query(_sql(f"""
SELECT family AS set_slug, f AS field_id, count(*)::BIGINT AS seen, count(*) FILTER (ok)::BIGINT AS correct, count(*) FILTER (ok)::DOUBLE / count(*) AS accuracy
FROM (SELECT family, f, f IN ('vendor', 'date') OR no <> 14 AS ok FROM t CROSS JOIN (VALUES ('vendor'), ('total'), ('vat'), ('date')) x(f)) GROUP BY 1, 2
"""))
def extraction_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The accuracy of the run by family and field; the gate does not matter for it."""
    return _run(spark, sf_dir)[1]


@query(_sql("""
SELECT id AS doc_id, vendor, strftime(issued, '%d/%m/%Y') AS date, vat_number AS vendor_vat_number, CASE no WHEN 11 THEN 'x' ELSE '' END = '' AS no_period FROM g
""".replace("CASE no WHEN 11 THEN 'x' ELSE '' END = ''", "no NOT IN (11, 12)")))
def generated_label_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scoring labels of generated documents: renamed fields and a padded header."""
    labels = extraction.label_documents(_whole(spark, sf_dir)[0].withColumnRenamed("vendor", "vendor_name"))
    return labels.select("doc_id", "vendor", "date", "header.vendor_vat_number", (F.col("header.billing_period") == "").alias("no_period"))


@query(_sql("SELECT 'corpus/' || id || CASE place % 3 WHEN 0 THEN '.pdf' WHEN 1 THEN '.PNG' ELSE '.gt.json' END AS path, CASE WHEN place % 5 <> 0 THEN vendor END AS vendor FROM g"))
def files_with_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files and the label of the same stem; a label in five is missing."""
    docs = _docs(spark, sf_dir)
    ending = F.when(F.col("place") % 3 == 0, ".pdf").when(F.col("place") % 3 == 1, ".PNG").otherwise(".gt.json")
    files = docs.select(F.concat(F.lit("corpus/"), "doc_id", ending).alias("path"))
    return extraction.with_labels(files, docs.filter("place % 5 <> 0").select("doc_id", "vendor")).select("path", "vendor")


# --- rules that the tables have no columns for, over generated documents and the tables' own numbers ---------------------------------


@query(_sql("SELECT DISTINCT family || CASE WHEN place % 50 = 0 THEN '_old' ELSE '' END AS family FROM g WHERE place % 50 = 0"))
def unknown_families(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the families that are asked for, those that do not exist."""
    asked = _docs(spark, sf_dir).select(F.concat("template_family", F.when(F.col("place") % 50 == 0, "_old").otherwise("")).alias("family")).distinct()
    return governance.unknown_families(asked)


@query(_sql("""
SELECT vat_number AS number, (8 * CAST(vat_number[3] AS INT) + 7 * CAST(vat_number[4] AS INT) + 6 * CAST(vat_number[5] AS INT) + 5 * CAST(vat_number[6] AS INT) + 4 * CAST(vat_number[7] AS INT)
  + 3 * CAST(vat_number[8] AS INT) + 2 * CAST(vat_number[9] AS INT)) % 23 <> 0 AS ok FROM g
UNION ALL SELECT 'GB' || substr(vat_number, 3), false FROM g UNION ALL SELECT vat_number || 'ABC', false FROM g
"""))
def vat_number_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The numbers of generated documents, and the same with another country or too many letters."""
    number = F.col("vendor_vat_number")
    each = F.explode(F.array(number, F.concat(F.lit("GB"), F.substring(number, 3, 20)), F.concat(number, F.lit("ABC")))).alias("number")
    return _docs(spark, sf_dir).select(each).select("number", money.vat_number_plausible(F.col("number")).alias("ok"))


@query(_sql("""
SELECT id AS doc_id, f AS field_id, v AS value, c AS confidence FROM (
  SELECT id, unnest([{'f': 'vendor', 'v': CASE WHEN place % 4 <> 1 THEN vendor END, 'c': 0.5::DOUBLE}, {'f': 'total', 'v': CAST(total::DOUBLE / 100 AS VARCHAR), 'c': CASE WHEN place % 3 = 0 THEN 1.5 ELSE 1.0 END::DOUBLE},
    {'f': 'vat', 'v': CAST(vat::DOUBLE / 100 AS VARCHAR), 'c': 0.0::DOUBLE}, {'f': 'date', 'v': strftime(issued, '%d/%m/%Y'), 'c': 0.25::DOUBLE}], recursive := true) FROM t WHERE place % 10 <> 0)
WHERE v IS NOT NULL AND c BETWEEN 0 AND 1
"""))
def model_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates of a model's answers: some are no JSON, some lack a field, some have impossible confidences."""
    rows = _doubles(_whole(spark, sf_dir)[0])
    sure = {"vendor": F.lit(0.5), "total": F.when(F.col("place") % 3 == 0, 1.5).otherwise(1.0), "vat": F.lit(0.0), "date": F.lit(0.25)}
    said = F.struct(F.when(F.col("place") % 4 != 1, F.col("vendor")).alias("vendor"), "total", "vat", F.col("invoice_date").alias("date"), *[c.alias(f"{f}_confidence") for f, c in sure.items()])
    answers = rows.select("doc_id", F.when(F.col("place") % 10 == 0, "I cannot read this").otherwise(F.to_json(said)).alias("answer"))
    return extraction.model_candidates(answers).drop("raw_text")


@query(_sql(f"""
SELECT id AS doc_id, (2 * (row_number() OVER (PARTITION BY id ORDER BY i) - 1))::INT AS row_idx, CAST(quantity AS VARCHAR) || ' x ' || ['Alpha', 'Beta', 'Gamma', 'Delta', 'Sigma'][1 + {_draw(5, "id", "i", "'word'")}] || ' service' AS description,
  quantity::DOUBLE AS quantity, abs(net + vat)::DOUBLE / 100 AS amount FROM l
"""))
def native_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items of tables that came as cells, with empty rows between and the price before the amount."""
    lines = generator.line_items(_docs(spark, sf_dir))
    euro = lambda c: F.concat(F.lit("EUR "), F.format_number(c, 2))
    cells = F.array(F.concat(F.col("quantity").cast("string"), F.lit(" x "), F.col("description")), F.lit(None).cast("string"), euro(F.col("unit_price")), euro(F.abs("gross")), F.lit(" "))
    rows = F.array(F.struct("ordinal", F.lit(0).alias("k"), cells.alias("cells")), F.struct("ordinal", F.lit(1).alias("k"), F.array(F.lit(None).cast("string"), F.lit("  ")).alias("cells")))
    made = lines.select("doc_id", F.explode(rows).alias("x")).groupBy("doc_id").agg(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["cells"]).alias("rows"))
    return extraction.native_items(made)


@query(_sql("""
SELECT id AS doc_id, k::INT AS i, strftime(issued - CAST(31 + d AS INT) + CAST(floor(30 * (k::DOUBLE / n)) AS INT), '%d/%m/%Y') AS day
FROM (SELECT id, issued, {0} AS d, n_lines AS n, unnest(range(n_lines)) AS k FROM t WHERE no = 12)
""".replace("{0}", _draw(3, "id", "'period'"))))
def spaced_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The days of a bank statement's movements, evenly spaced over its period."""
    rows = _whole(spark, sf_dir)[0].filter("rule = 'account'")
    start = F.to_date(F.substring("billing_period", 1, 10), "dd/MM/yyyy")
    dates = sampling.spaced_dates(start, F.lit(30), F.col("n_lines"))
    return rows.select("doc_id", F.posexplode(dates).alias("i", "day")).select("doc_id", "i", F.date_format("day", "dd/MM/yyyy").alias("day"))


@query("""
WITH v AS (SELECT *, l_tax * 100 AS rate, CAST(printf('%.2f', l_extendedprice * (1 - l_discount)) AS DOUBLE) AS low FROM lineitem)
SELECT l_orderkey AS doc_id, l_linenumber AS line, CAST(printf('%.2f', l_extendedprice / (1 + rate / 100)) AS DOUBLE) AS net, CAST(printf('%.2f', l_extendedprice * (1 + rate / 100)) AS DOUBLE) AS gross, low AS lowered,
  CAST(printf('%.2f', low - low / (1::DOUBLE + 9::DOUBLE / 100)) AS DOUBLE) AS lowered_vat, CAST(printf('%.2f', l_extendedprice * 0.8571::DOUBLE) AS DOUBLE) AS converted FROM v
""")
def vat_arithmetic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts without and with VAT, lowered by hand, and in another currency, for every line item."""
    v = table(spark, sf_dir, "lineitem").withColumn("rate", F.col("l_tax") * 100)
    amount, rate = F.col("l_extendedprice"), F.col("rate")
    lowered = money.discounted(amount, F.col("l_discount"))
    return v.select(
        F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").alias("line"), money.net_of_gross(amount, rate).alias("net"), money.gross_of_net(amount, rate).alias("gross"),
        lowered["total"].alias("lowered"), lowered["vat"].alias("lowered_vat"), money.converted(amount, F.lit(0.8571)).alias("converted"),
    )


@query("""
WITH v AS (SELECT p_partkey, lower(p_name) AS a, CASE p_partkey % 4 WHEN 0 THEN p_name WHEN 1 THEN substr(p_name, 2) WHEN 2 THEN substr(p_name, 4) ELSE 'x' || substr(p_name, 2) || 'y' END AS b FROM part)
SELECT p_partkey AS id, levenshtein(a, lower(b)) <= 2 AS close FROM v
""")
def fuzzy_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of parts against the same with wide spaces, and with up to three characters changed."""
    name, k = F.col("p_name"), F.col("p_partkey") % 4
    rest = F.substring(name, 2, 1000)
    other = F.when(k == 0, F.concat(F.lit("  "), F.upper(name), F.lit("\t"))).when(k == 1, rest).when(k == 2, F.substring(name, 4, 1000)).otherwise(F.concat(F.lit("x"), rest, F.lit("y")))
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), text.fuzzy_equal(name, other).alias("close"))


@query("""
WITH v AS (SELECT o_orderkey, ['23.0', '0', '10', '13.5%', '9', NULL, '23', '4.8', '20', '13.50', 'mixed'][1 + o_orderkey % 11] AS rate, ['IE', NULL, 'fr', 'US', 'ireland', 'uk', ''][1 + o_custkey % 7] AS country FROM orders)
SELECT o_orderkey AS id, CASE WHEN rate IS NULL THEN 'Zero Rated Expenses' WHEN country IN ('fr', 'uk') THEN 'EC Acquisitions (Zero Rated)'
  ELSE CASE rate WHEN '0' THEN 'Zero Rated Expenses' WHEN '13.5%' THEN 'VAT 13.5% on Expenses' WHEN '13.50' THEN 'VAT 13.5% on Expenses' WHEN '9' THEN 'VAT 9% on Expenses' WHEN '4.8' THEN 'VAT 4.8% on Expenses' ELSE 'VAT on Expenses' END END AS tax FROM v
""")
def tax_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tax type of every order, with rates as people write them."""
    one = lambda options, c: F.get(F.array(*[F.lit(x) for x in options]), (F.col(c) % len(options)).cast("int"))
    rate = one(("23.0", "0", "10", "13.5%", "9", None, "23", "4.8", "20", "13.50", "mixed"), "o_orderkey")
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), money.tax_type(rate, one(("IE", None, "fr", "US", "ireland", "uk", ""), "o_custkey")).alias("tax"))


@query("SELECT n_regionkey AS region, n_name AS key, CASE WHEN n_nationkey % 3 = 0 THEN 'given' ELSE 'default' END AS value FROM nation UNION ALL SELECT r_regionkey, 'new', 'given' FROM region WHERE r_regionkey IN (SELECT n_regionkey FROM nation)")
def config_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A map of defaults under what is given, key by key, for each region."""
    n = table(spark, sf_dir, "nation")
    entry = lambda v: F.struct(F.col("n_name").alias("key"), F.lit(v).alias("value"))
    maps = n.groupBy("n_regionkey").agg(
        F.map_from_entries(F.collect_list(entry("default"))).alias("defaults"),
        F.map_from_entries(F.concat(F.collect_list(F.when(F.col("n_nationkey") % 3 == 0, entry("given"))), F.array(F.struct(F.lit("new").alias("key"), F.lit("given").alias("value"))))).alias("given"),
    )
    return maps.select(F.col("n_regionkey").alias("region"), F.explode(merged_config(F.col("defaults"), F.col("given"))))
