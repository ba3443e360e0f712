"""Validation, cross-field checks and the confidence gate over long tables of extracted fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.fields import DATE, FIELDS
from ledgerloom.functions.money import near_statutory, rounded, two_decimals

THRESHOLD, FLOOR, VERIFY_BELOW = 0.98, 0.80, 0.85
# What bounces a document across its fields.
ODD_RATIO, TOO_MUCH_VAT, BAD_DATE = "vat/total ratio %s not within ±0.005 of IE rates (0%%, 4.8%%, 9%%, 13.5%%, 23%%)", "vat (%s) exceeds total (%s)", "date schema invalid: %s"


def field_valid(field_id: Column, value: Column) -> Column:
    """(ok, reason) of one value given as text."""
    number = value.try_cast("double")
    parts = F.split(F.regexp_extract(value, DATE, 1), "[/-]")
    d, m, y0 = (F.try_element_at(parts, F.lit(i)).try_cast("int") for i in (1, 2, 3))
    y = F.when(y0 < 100, y0 + 2000).otherwise(y0)
    said = lambda ok, why: F.struct(F.lit(ok).alias("ok"), F.lit(why).alias("reason"))
    good = said(True, "ok")
    name = F.when(F.length(value).between(3, 80) & F.regexp_like(value, F.lit(r"\p{L}")), good).otherwise(said(False, "length or letters"))
    amount = F.when(number.isNull(), said(False, "not a number")).when(number.between(0, 1_000_000), good).otherwise(said(False, "out of range"))
    day = F.when(~F.regexp_like(value, F.lit("^" + DATE)), said(False, "no date")).when(d.between(1, 31) & m.between(1, 12) & y.between(1900, 2100), good).otherwise(said(False, "date parts"))
    return F.when(value.isNull(), said(False, "no value")).when(field_id == "vendor", name).when(field_id.isin("total", "vat"), amount).when(field_id == "date", day).otherwise(good)


def needs_verifier(agreed: Column, confidence: Column) -> Column:
    return ~F.coalesce(agreed, F.lit(False)) | (confidence < VERIFY_BELOW)


def composite(value: Column, agreed: Column, valid: Column, ocr: Column, verifier: Column) -> Column:
    """Final confidence of a field."""
    agreed, valid, ocr = F.coalesce(agreed, F.lit(False)), F.coalesce(valid, F.lit(False)), F.coalesce(ocr, F.lit(0.0))
    weighed = F.least(F.lit(1.0), ocr * 0.30 + verifier * 0.55 + F.when(valid, 0.15).otherwise(0.0))
    return F.when(value.isNull(), 0.0).when(agreed & valid, F.least(F.lit(1.0), ocr * 1.05)).when(verifier.isNotNull(), weighed).otherwise(ocr * 0.5)


def cross_field(vat: Column, total: Column) -> Column:
    """(ratio, plausible, implausible_ratio, vat_exceeds_total); a total that is not positive has ratio 0."""
    known = vat.isNotNull() & total.isNotNull()
    ratio = F.when(total > 0, F.try_divide(vat, total)).otherwise(0.0)
    odd = ~near_statutory(ratio) & (total > 0)
    return F.struct(
        F.when(known, rounded(ratio, 4)).alias("ratio"),
        F.when(known, near_statutory(ratio)).alias("plausible"),
        F.coalesce(known & odd, F.lit(False)).alias("implausible_ratio"),
        F.coalesce(known & (vat > total), F.lit(False)).alias("vat_exceeds_total"),
    )


def bounces(vat: Column, total: Column, date: Column) -> Column:
    """The reasons across fields that bounce a document; amounts as doubles, the date as text. Null values give none."""
    found, day = cross_field(vat, total), field_valid(F.lit("date"), date)
    said = [
        F.when(found["implausible_ratio"], F.format_string(ODD_RATIO, F.format_string("%.4f", rounded(F.try_divide(vat, total), 4)))),
        F.when(found["vat_exceeds_total"], F.format_string(TOO_MUCH_VAT, vat.cast("string"), total.cast("string"))),
        F.when(date.isNotNull() & ~day["ok"], F.format_string(BAD_DATE, day["reason"])),
    ]
    return F.array_compact(F.array(*said))


def gate(fields: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, gate_passed, bounce_reason from (doc_id, field_id, value, agreed, valid, ocr, verifier, bounces).

    bounces: array of cross-field reasons, the same on all rows of a document. Parts come in the order of FIELDS. A critical
    field without a row counts as one without a value: it fails at 0.00.
    """
    asked = fields.groupBy("doc_id").agg(F.first("bounces").alias("bounces")).withColumn("field_id", F.explode(F.array(*map(F.lit, FIELDS))))
    fields = asked.join(fields.drop("bounces"), ["doc_id", "field_id"], "left")
    final = composite(*[F.col(c) for c in ("value", "agreed", "valid", "ocr", "verifier")])
    place = F.array_position(F.array(*map(F.lit, FIELDS)), F.col("field_id"))
    rows = fields.withColumn("final", final).withColumn("place", place)
    part = F.struct("place", F.concat("field_id", F.lit("="), two_decimals(F.col("final"))).alias("said"))
    said = lambda c: F.concat_ws(", ", F.transform(F.sort_array(c), lambda x: x["said"]))
    docs = rows.groupBy("doc_id").agg(F.collect_list(F.when(F.col("final") < threshold, part)).alias("failing"), F.first("bounces").alias("bounces"))
    low, crossed = F.size("failing") > 0, F.size(F.coalesce("bounces", F.array().cast("array<string>"))) > 0
    reason = F.concat_ws(" | ", F.when(low, F.concat(F.lit("below-threshold: "), said(F.col("failing")))), F.when(crossed, F.concat(F.lit("cross-field: "), F.concat_ws("; ", "bounces"))))
    return docs.select("doc_id", (~low & ~crossed).alias("gate_passed"), F.nullif(reason, F.lit("")).alias("bounce_reason"))
