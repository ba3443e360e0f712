"""Voting between extractors over long tables (doc_id, field_id, engine, ordinal, raw_text, value)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.fields import FIELDS
from ledgerloom.functions.text import values_match

NATIVE = "pdfplumber-"


def word_confidence(words: DataFrame) -> DataFrame:
    """(doc_id, engine, confidence) from words (doc_id, engine, text, conf in per cent): blank and unsure words leave."""
    good = (F.trim("text") != "") & (F.col("conf") > 0)
    return words.groupBy("doc_id", "engine").agg(F.coalesce(F.avg(F.when(good, F.col("conf") / 100)), F.lit(0.0)).alias("confidence"))


def vote(candidates: DataFrame, confidences: DataFrame, money: tuple[str, ...] = ("total", "vat"), fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """For each document and field the longest candidate (the first of equals), who agrees with it, and confidence.

    All engines must agree, and be two at least; a single native reading is agreed at confidence 1. The confidence is
    the mean of the engines' means. Every document of candidates gets a row for each of `fields`: one that nobody read has
    no value, is not agreed and has confidence 0.
    """
    real = candidates.filter((F.coalesce(F.col("raw_text"), F.lit("")) != "") | F.col("value").isNotNull())
    real = real.join(confidences, ["doc_id", "engine"], "left").withColumn("confidence", F.coalesce("confidence", F.lit(0.0)))
    key = Window.partitionBy("doc_id", "field_id")
    first = F.first(F.struct("engine", "raw_text", "value")).over(key.orderBy(F.length(F.coalesce("raw_text", F.lit(""))).desc(), "ordinal").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    rows = real.withColumn("ref", first)
    number, text = (values_match(F.col("ref.value"), F.col("value"), m) for m in (True, False))
    same = F.when(F.col("field_id").isin(*money), number).otherwise(text)
    rows = rows.withColumn("agrees", (F.col("engine") == F.col("ref.engine")) | same)
    out = rows.groupBy("doc_id", "field_id").agg(
        F.first("ref").alias("ref"),
        F.count(F.lit(1)).alias("candidates"),
        F.count_if("agrees").alias("agreed"),
        F.avg("confidence").alias("mean_confidence"),
    )
    native = (F.col("candidates") == 1) & F.startswith("ref.engine", F.lit(NATIVE))
    asked = candidates.select("doc_id").distinct().select("doc_id", F.explode(F.array(*map(F.lit, fields))).alias("field_id"))
    out = asked.join(out, ["doc_id", "field_id"], "left").withColumns({c: F.coalesce(c, F.lit(0).cast("long")) for c in ("candidates", "agreed")})
    return out.select(
        "doc_id", "field_id", F.col("ref.engine").alias("ref_engine"), F.col("ref.raw_text").alias("raw_text"), F.col("ref.value").alias("value"),
        "candidates", "agreed",
        F.when(native, True).otherwise((F.col("agreed") == F.col("candidates")) & (F.col("candidates") >= 2)).alias("agreement"),
        F.when(native, 1.0).otherwise(F.coalesce("mean_confidence", F.lit(0.0))).alias("ocr_confidence"),
    )
