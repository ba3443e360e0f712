"""Corpus manifest: licence summary and violations, contract checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The licence that needs care, and the roles that may carry it.
NON_COMMERCIAL = "CC-BY-NC-SA-4.0"
PERMITTED_ROLES = ("EVAL-ONLY-PRIVATE", "BACKFILL")

# Template families, and corruption buckets with their shares.
FAMILIES = (
    "tradesman_rct", "cafe_receipt", "gp_medical", "vet", "solicitor_loe", "restaurant_thermal", "supermarket_per_letter_vat", "photographed_receipt",
    "handwritten_override", "mixed_rate_retailer", "professional_services", "utility_bill", "bank_statement", "construction_supplier", "credit_note",
    "foreign_currency_mixed_vat",
)
BUCKETS = (("clean", 0.30), ("light", 0.45), ("heavy", 0.20), ("very-heavy", 0.05))


def violates(license_tag: Column, role: Column) -> Column:
    return (license_tag == NON_COMMERCIAL) & ~role.isin(*PERMITTED_ROLES)


def licence_manifest(entries: DataFrame) -> DataFrame:
    """Documents by source, licence and role, with a mark on groups that break the licence."""
    out = entries.groupBy("source", "license_tag", "role").agg(F.count(F.lit(1)).alias("n"))
    return out.withColumn("violation", violates(F.col("license_tag"), F.col("role"))).orderBy("source", "license_tag", "role")


def licence_violations(entries: DataFrame) -> DataFrame:
    return entries.filter(violates(F.col("license_tag"), F.col("role")))


def contract_violations(labels: DataFrame) -> DataFrame:
    """(doc_id, rule) of every broken rule of label documents (doc_id, template_family, corruption_bucket, vat_rate, total)."""
    rules = {
        "doc_id": ~F.regexp_like("doc_id", F.lit("^synth-[a-f0-9]{12}$")),
        "template_family": ~F.col("template_family").isin(*FAMILIES),
        "corruption_bucket": ~F.col("corruption_bucket").isin(*[b for b, _ in BUCKETS]),
        "vat_rate": ~F.col("vat_rate").isin(0.0, 4.8, 9.0, 13.5, 23.0),
        "total": F.col("total").isNull(),
    }
    broken = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(True) if k == "doc_id" else F.lit(False)), F.lit(k)) for k, c in rules.items()]))
    return labels.select("doc_id", F.explode(broken).alias("rule"))


def unknown_families(asked: DataFrame) -> DataFrame:
    """Of asked (family), those that do not exist."""
    known = asked.sparkSession.createDataFrame([(f,) for f in FAMILIES], "family string")
    return asked.join(F.broadcast(known), "family", "left_anti")  # 16 rows


# What a label document must hold.
SCHEMA_VERSION, CONTRACTS, LICENCE = "0.4", r"^0\.4\.2-step[0-9]+(\.[0-9]+)?$", "Apache-2.0"
ORIGINAL_FORMS = ("digital_native", "image_only_pdf", "paper_scan", "photo")
ATTESTATION = "original-form-preserved"
LABEL_RATES = (0.0, 4.8, 9.0, 13.5, 23.0)


def broken_rules(most: int | None = None) -> Column:
    """Names of the rules that a label document breaks, in the schema's order, the first `most` of them.

    Columns: doc_id, source_path, schema_version, contracts_version, template_family, corruption_bucket, fields (struct), rates (of
    the lines, each null or one of a list), provenance (struct), synthetic_seed, synthetic_generator_commit, license_tag.
    """
    here = lambda c: F.col(c).isNotNull()
    like = lambda c, p: F.regexp_like(c, F.lit(p))
    rules = {
        "doc_id": like("doc_id", "^synth-[a-f0-9]{12}$"),
        "source_path": here("source_path"),
        "schema_version": F.col("schema_version") == SCHEMA_VERSION,
        "contracts_version": like("contracts_version", CONTRACTS),
        "template_family": F.col("template_family").isin(*FAMILIES),
        "corruption_bucket": F.col("corruption_bucket").isin(*[b for b, _ in BUCKETS]),
        **{f"fields.{c}": here(f"fields.{c}") for c in ("vendor", "total", "vat")},
        "fields.date": like("fields.date", r"^\d{2}/\d{2}/\d{4}$"),
        "fields.subtotal": here("fields.subtotal"),
        "fields.vendor_country": like("fields.vendor_country", "^[A-Z]{2}$"),
        "line_items.vat_rate_pct": F.forall("rates", lambda r: r.isNull() | r.isin(*LABEL_RATES)),
        "provenance.original_form": F.col("provenance.original_form").isin(*ORIGINAL_FORMS),
        "provenance.source_engine": here("provenance.source_engine"),
        "provenance.file_sha256": like("provenance.file_sha256", "^[a-f0-9]{64}$"),
        "provenance.file_size_bytes": F.coalesce(F.col("provenance.file_size_bytes") >= 0, F.lit(True)),
        "provenance.ingest_timestamp_utc": here("provenance.ingest_timestamp_utc"),
        "provenance.page_count": F.col("provenance.page_count") >= 1,
        "provenance.vatca_attestation": F.col("provenance.vatca_attestation") == ATTESTATION,
        "synthetic_seed": here("synthetic_seed"),
        "synthetic_generator_commit": like("synthetic_generator_commit", "^[a-f0-9]{40}$|^pending$"),
        "license_tag": F.col("license_tag") == LICENCE,
    }
    broken = F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()]))
    return F.slice(broken, 1, most) if most else broken


def require_valid(labels: DataFrame, most: int = 3) -> DataFrame:
    """labels as they are; reading a row that breaks a rule is an error that names the first ones."""
    broken = broken_rules(most)
    said = F.concat(F.lit("label "), F.coalesce("doc_id", F.lit("without doc_id")), F.lit(" breaks "), F.array_join(broken, ", "))
    return labels.filter(F.when(F.size(broken) > 0, F.raise_error(said).cast("boolean")).otherwise(True))


def first_ingests(entries: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Of entries (tenant_id, file_sha256, created_at, id) the first of each tenant's file, without files that are known already."""
    first = entries.groupBy("tenant_id", "file_sha256").agg(F.min(F.struct("created_at", "id")).alias("first"))
    out = first.select("tenant_id", "file_sha256", "first.*")
    return out if known is None else out.join(known.select("tenant_id", "file_sha256").distinct(), ["tenant_id", "file_sha256"], "left_anti")


def manifest_report(manifest: DataFrame) -> str:
    """licence_manifest() as a Markdown table; one row a group, so it is gathered on the driver."""
    rows = manifest.orderBy("source", "license_tag", "role").collect()
    lines = ["| Source | Licence | Role | Documents | |", "| --- | --- | --- | --- | --- |"]
    lines += [f"| {r['source']} | {r['license_tag']} | {r['role']} | {r['n']} | {'violation' if r['violation'] else ''} |" for r in rows]
    return "\n".join(lines) + "\n"
