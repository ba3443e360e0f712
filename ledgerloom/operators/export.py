"""Supplier bills as rows of an accounting import file: 29 text columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.money import due_date, format_date, money_text, tax_type

# The file's columns in order.
HEADER = (
    "ContactName", "EmailAddress", "POAddressLine1", "POAddressLine2", "POAddressLine3", "POAddressLine4", "POCity", "PORegion", "POPostalCode", "POCountry",
    "InvoiceNumber", "Reference", "InvoiceDate", "DueDate", "Total", "InventoryItemCode", "Description", "Quantity", "UnitAmount", "Discount",
    "AccountCode", "TaxType", "TaxAmount", "TrackingName1", "TrackingOption1", "TrackingName2", "TrackingOption2", "Currency", "BrandingTheme",
)
# The reference's prefix, and what stands where a supplier or a description is missing.
REFERENCE, NO_SUPPLIER, NO_DESCRIPTION = "DocOps:", "Unknown supplier", "Supplier invoice"
# What a configuration file may override.
DEFAULTS = {"default_account_code": "404", "default_tax_type": "VAT on Expenses", "default_due_days": 30, "default_currency": "EUR", "tax_rate_map": {}}


def _given(c: Column) -> Column:
    """Null where text is missing or empty."""
    return F.nullif(c.cast("string"), F.lit(""))


def clean(extractions: DataFrame, tenant: str, ids: list[str] | None = None) -> DataFrame:
    """What may be exported: the tenant's extractions (id, tenant_id, gate_passed, created_at) that passed the gate, oldest first; of `ids` only, if given."""
    passed = extractions.filter((F.col("tenant_id") == tenant) & F.col("gate_passed"))
    return (passed if ids is None else passed.filter(F.col("id").cast("string").isin(*ids))).orderBy("created_at", "id")


def bills(payloads: DataFrame, config: dict | None = None) -> DataFrame:
    """Rows of the file from payloads (doc_id and the bill's fields); missing fields are null.

    config overrides defaults key by key, the tax map rate by rate.
    """
    c = DEFAULTS | (config or {})
    have = set(payloads.columns)
    col = lambda n, kind="string": F.col(n) if n in have else F.lit(None).cast(kind)
    name = F.btrim(F.coalesce(col("vendor"), F.lit("")))
    when = format_date(F.coalesce(_given(col("date")), _given(col("invoice_date"))))
    net = F.coalesce(col("subtotal", "double"), col("total", "double") - F.coalesce(col("vat", "double"), F.lit(0.0)))
    country = F.btrim(F.coalesce(col("vendor_country"), F.lit("")))
    values = {
        "ContactName": F.coalesce(F.nullif(name, F.lit("")), F.lit(NO_SUPPLIER)),
        "POCountry": country,
        "InvoiceNumber": F.btrim(F.coalesce(_given(col("invoice_number")), _given(F.col("doc_id")), F.lit(""))),
        "Reference": F.concat(F.lit(REFERENCE), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))),
        "InvoiceDate": when,
        "DueDate": due_date(when, c["default_due_days"]),
        "Total": money_text(col("total", "double")),
        "Description": F.coalesce(_given(col("description")), F.nullif(name, F.lit("")), F.lit(NO_DESCRIPTION)),
        "Quantity": F.lit("1"),
        "UnitAmount": money_text(net),
        "AccountCode": F.lit(c["default_account_code"]),
        "TaxType": tax_type(_given(col("vat_rate")), country, c["tax_rate_map"], c["default_tax_type"]),
        "TaxAmount": money_text(col("vat", "double")),
        "Currency": F.coalesce(_given(col("currency")), F.lit(c["default_currency"])),
    }
    return payloads.select(*[values.get(h, F.lit("")).alias(h) for h in HEADER])
