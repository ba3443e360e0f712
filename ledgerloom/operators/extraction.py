"""The relational steps around the model slots: engine texts, typed model answers, native tables, verdicts, labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.fields import FIELDS, date, total, vat, vendor
from ledgerloom.functions.money import TABLE_MONEY, first_amount, first_quantity
from ledgerloom.functions.text import strip

# Characters of text a model extractor and a verifier get; shapes of VAT and account numbers.
MODEL_CHARS, VERIFIER_CHARS = 6000, 4000
VAT_NUMBER = r"(?i)\b(?:VAT(?:\s*No\.?)?[:\s]*)?(IE\d{7}[A-Z]{1,2})\b"
IBAN = r"\b([A-Z]{2}\d{2}[A-Z0-9]{4}\d{7}[A-Z0-9]{0,16})\b"
#: What a model must answer: a value and a confidence in [0, 1] for each field.
ANSWER = "vendor string, total double, vat double, date string, vendor_confidence double, total_confidence double, vat_confidence double, date_confidence double"


def model_text(rows: DataFrame) -> DataFrame:
    """engine_text() cut to what a model extractor takes, of the documents that need one."""
    return engine_text(by_origin(rows)[1], MODEL_CHARS)


def engine_text(rows: DataFrame, limit: int = VERIFIER_CHARS) -> DataFrame:
    """(doc_id, text): the engines' texts in their order, a line feed between them, cut to what a verifier takes."""
    some = rows.filter(F.coalesce(F.col("raw_text"), F.lit("")) != "")
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ordinal", "raw_text"))), lambda x: x["raw_text"]), "\n")
    return some.groupBy("doc_id").agg(F.substring(joined, 1, limit).alias("text"))


def model_candidates(answers: DataFrame) -> DataFrame:
    """Candidates (doc_id, field_id, raw_text, value, confidence) of typed answers (doc_id, answer as JSON).

    Answers that are no JSON, and confidences outside [0, 1], leave no candidate.
    """
    a = F.from_json("answer", ANSWER)
    each = [F.struct(F.lit(f).alias("field_id"), a[f].cast("string").alias("value"), a[f"{f}_confidence"].alias("confidence")) for f in FIELDS]
    rows = answers.select("doc_id", F.explode(F.array(*each)).alias("x")).select("doc_id", "x.*")
    good = rows.filter(F.col("value").isNotNull() & F.col("confidence").between(0, 1))
    return good.select("doc_id", "field_id", F.col("value").alias("raw_text"), "value", "confidence")


def flat_rows(tables: DataFrame) -> DataFrame:
    """The rows of all tables of a document (doc_id, tables: arrays of tables of rows of cells) as one array; missing cells are empty."""
    return tables.select("doc_id", F.transform(F.flatten("tables"), lambda row: F.transform(row, lambda c: F.coalesce(c, F.lit("")))).alias("rows"))


def native_items(tables: DataFrame) -> DataFrame:
    """Line items of tables that came as cells (doc_id, rows: arrays of arrays): missing cells are empty, empty rows leave.

    The amount is the last cell with one, the description the longest cell without, the first of equals.
    """
    cells = F.transform("cells", lambda c: strip(F.coalesce(c, F.lit(""))))
    rows = tables.select("doc_id", F.posexplode("rows").alias("row_idx", "cells")).withColumn("cells", cells).filter(F.exists("cells", lambda c: c != ""))
    amounts = F.filter(F.transform("cells", lambda c: first_amount(c, TABLE_MONEY)), lambda v: v.isNotNull())
    words = F.filter("cells", lambda c: (c != "") & first_amount(c, TABLE_MONEY).isNull())
    longest = F.array_max(F.transform(words, lambda c: F.length(c)))
    description = F.get(F.filter(words, lambda c: F.length(c) == longest), F.lit(0))
    out = rows.withColumn("amount", F.try_element_at(amounts, F.lit(-1))).filter("amount is not null").withColumn("description", description)
    return out.select("doc_id", "row_idx", "description", first_quantity(F.col("description")).alias("quantity"), "amount")


def with_verdicts(fields: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Verdicts (doc_id, field_id, verdict, verifier) on the fields; fields that were not asked about have nulls."""
    return fields.join(verdicts, ["doc_id", "field_id"], "left")


def by_origin(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Native documents, and those that need a model: two branches, so that no model function sees a native row."""
    native = F.col("original_form") == "digital_native"
    return docs.filter(native), docs.filter(~F.coalesce(native, F.lit(False)))


#: Text fields of a label's header; what a document lacks is empty there.
HEADER_TEXT = ("vendor_vat_number", "vendor_iban", "vendor_bic", "invoice_number", "due_date", "po_reference", "references_invoice", "delivery_note_ref", "billing_period")


def label_documents(truth: DataFrame) -> DataFrame:
    """Scoring labels from native ones: two fields renamed, and a header in which missing text is empty."""
    have = set(truth.columns)
    text = lambda c: (F.coalesce(F.col(c), F.lit("")) if c in have else F.lit("")).alias(c)
    header = F.struct(*[text(c) for c in HEADER_TEXT]).alias("header")
    return truth.select("doc_id", F.col("vendor_name").alias("vendor"), F.col("invoice_date").alias("date"), "total", "vat", "subtotal", "vendor_country", header)


def extracted(texts: DataFrame) -> DataFrame:
    """Candidates (doc_id, field_id, engine, ordinal, raw_text, value) of the engines' texts (doc_id, engine, ordinal, text)."""
    t = F.col("text")
    amount = lambda c: c.cast("decimal(18,2)").cast("string")
    found = {"vendor": vendor(t), "total": amount(total(t)), "vat": amount(vat(t)), "date": date(t)}
    each = F.explode(F.array(*[F.struct(F.lit(f).alias("field_id"), found[f].alias("value")) for f in FIELDS])).alias("x")
    rows = texts.select("doc_id", "engine", "ordinal", each).select("doc_id", "engine", "ordinal", "x.*")
    return rows.select("doc_id", "field_id", "engine", "ordinal", F.coalesce("value", F.lit("")).alias("raw_text"), "value")


def corrupted(labels: DataFrame, bucket: Column) -> DataFrame:
    """Labels of corrupted copies: the bucket and the path change, nothing else."""
    path = F.concat(F.lit("corrupted/"), bucket, F.lit("/"), F.element_at(F.split("source_path", "/"), -1))
    return labels.withColumn("corruption_bucket", bucket).withColumn("source_path", path)


def with_labels(files: DataFrame, labels: DataFrame) -> DataFrame:
    """Files with the label of the same stem; files without one stay."""
    stem = F.regexp_extract("path", r"([^/]+?)(?:\.gt)?\.[^./]+$", 1)
    return files.withColumn("stem", stem).join(labels, F.col("stem") == labels["doc_id"], "left")


def first_engine_wins(rows: DataFrame) -> DataFrame:
    """The longest text of each document, the first engine of equals."""
    order = Window.partitionBy("doc_id").orderBy(F.length("raw_text").desc(), "ordinal")
    return rows.withColumn("_place", F.row_number().over(order)).filter("_place = 1").drop("_place")


def numbers(text: Column) -> Column:
    """The first VAT number and account number of a text."""
    found = lambda p: F.nullif(F.regexp_extract(text, p, 1), F.lit(""))
    return F.struct(found(VAT_NUMBER).alias("vat_number"), found(IBAN).alias("iban"))
