"""Reviewer corrections: latest of each field, join with extractions, training pairs, shard metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

KEY = ["extraction_id", "field_id"]


def latest(corrections: DataFrame, ordinal: str = "ordinal") -> DataFrame:
    """The last correction of each field by submitted_at as text; of equal ones the first that was read."""
    order = Window.partitionBy(*KEY).orderBy(F.col("submitted_at").desc(), F.col(ordinal))
    return corrections.withColumn("_place", F.row_number().over(order)).filter("_place = 1").drop("_place")


def last_wins(rows: DataFrame, key: str, ordinal: str = "ordinal") -> DataFrame:
    order = Window.partitionBy(key).orderBy(F.col(ordinal).desc())
    return rows.withColumn("_place", F.row_number().over(order)).filter("_place = 1").drop("_place")


def replay(corrections: DataFrame, extractions: DataFrame) -> DataFrame:
    """Corrections with their extraction's columns, in the order they were submitted."""
    return corrections.join(extractions, "extraction_id").orderBy("submitted_at", "id")


def training_pairs(corrections: DataFrame, extractions: DataFrame) -> DataFrame:
    """Latest corrections with their extraction; corrections of unknown extractions leave."""
    return latest(corrections).join(last_wins(extractions, "extraction_id", "extraction_ordinal").drop("extraction_ordinal"), "extraction_id")


def shard_metrics(corrections: DataFrame, pairs: DataFrame, extractions: DataFrame) -> DataFrame:
    """(metric, key, n): totals, and training pairs by field and by tenant."""
    total = lambda df, name: df.agg(F.lit(name).alias("metric"), F.lit("all").alias("key"), F.count(F.lit(1)).alias("n"))
    by = lambda c, name: pairs.groupBy(F.col(c).cast("string").alias("key")).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("metric"), "key", "n")
    parts = [total(corrections, "raw_corrections"), total(latest(corrections), "deduped_corrections"), total(pairs, "training_pairs"), total(extractions, "extractions_total"), by("field_id", "per_field"), by("tenant_id", "per_tenant")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
