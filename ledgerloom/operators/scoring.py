"""Scores of extraction results against ground truth. One job for all sets; sets are a column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.fields import FIELDS
from ledgerloom.functions.text import scored_text


def ratio(a: Column, b: Column) -> Column:
    """a / b, 0 where b is 0."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def truth_rows(labels: DataFrame, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """Truth (doc_id, field_id, expected) of label documents, one row a field, values as text."""
    return labels.select("doc_id", *[F.col(f).cast("string").alias(f) for f in fields]).unpivot(["doc_id"], list(fields), "field_id", "expected")


def compare_fields(results: DataFrame, truth: DataFrame) -> DataFrame:
    """Joins (doc_id, field_id, value) with (doc_id, field_id, expected); fields without truth are not scored.

    Where truth has an `ordinal`, the last row of a document's field holds, also if that has no value.
    """
    if "ordinal" in truth.columns:
        truth = truth.groupBy("doc_id", "field_id").agg(F.max_by("expected", "ordinal").alias("expected"))
    known = truth.filter("expected is not null")
    return results.join(known, ["doc_id", "field_id"]).withColumn("correct", scored_text(F.col("value")) == scored_text(F.col("expected")))


def field_accuracy(compared: DataFrame) -> DataFrame:
    """Seen and correct by set and field, the gate ignored."""
    out = compared.groupBy("set_slug", "field_id").agg(F.count(F.lit(1)).alias("seen"), F.count_if("correct").alias("correct"))
    return out.withColumn("accuracy", ratio(F.col("correct"), F.col("seen")))


def scorecard(docs: DataFrame, compared: DataFrame) -> DataFrame:
    """By set: documents, passed, bounced, silent failures (passed with a scored field wrong) and their rates.

    docs: (set_slug, doc_id, gate_passed, elapsed_s); documents without truth still count.
    """
    wrong = compared.groupBy("doc_id").agg(F.max((~F.col("correct")).cast("int")).alias("wrong"))
    joined = docs.join(wrong, "doc_id", "left")
    passed = F.coalesce(F.col("gate_passed"), F.lit(False))
    out = joined.groupBy("set_slug").agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.count_if(passed).alias("passed"),
        F.count_if(~passed).alias("bounced"),
        F.count_if(passed & (F.col("wrong") == 1)).alias("silent_failures"),
        F.sum("elapsed_s").alias("total_time_s"),
    )
    n = F.col("n_docs")
    return out.select(
        "*",
        ratio(F.col("passed"), n).alias("straight_through_rate"),
        ratio(F.col("bounced"), n).alias("bounce_rate"),
        ratio(F.col("silent_failures"), F.col("passed")).alias("silent_failure_rate"),
        ratio(F.col("total_time_s"), n).alias("mean_s"),
    )


def totals(card: DataFrame) -> DataFrame:
    """The scorecard over all sets."""
    out = card.agg(*[F.sum(c).alias(c) for c in ("n_docs", "passed", "bounced", "silent_failures")])
    return out.withColumn("straight_through_rate", ratio(F.col("passed"), F.col("n_docs"))).withColumn("silent_failure_rate", ratio(F.col("silent_failures"), F.col("passed")))


#: What a production run must reach: straight through at least, silent failures below.
TARGETS = "- Straight-through rate at least 97 %\n- Accuracy of a field at least 99 %\n- Silent failures below 2 %\n"


def markdown(card: DataFrame, accuracy: DataFrame | None = None) -> str:
    """The scorecard, and the accuracy of fields if given, as Markdown tables; a few rows a set, so they are gathered on the driver."""

    def table(head: list[str], rows: list[list[str]]) -> str:
        return "\n".join("| " + " | ".join(map(str, r)) + " |" for r in [head, ["---"] * len(head), *rows]) + "\n"

    rows = card.orderBy("set_slug").collect()
    head = ["Set", "N", "Pass", "Bounce", "STR", "Bounce %", "Silent fail", "Avg s/doc"]
    body = [[r["set_slug"], r["n_docs"], r["passed"], r["bounced"], f"{r['straight_through_rate']:.1%}", f"{r['bounce_rate']:.1%}", f"{r['silent_failures']} ({r['silent_failure_rate']:.1%})", f"{r['mean_s']:.1f}"] for r in rows]
    parts = [f"Sets scored: {len(rows)}\n", table(head, body)]
    if accuracy is not None:
        found = {(r["set_slug"], r["field_id"]): r for r in accuracy.collect()}
        fields = sorted({f for _, f in found})
        cell = lambda r: f"{r['correct']}/{r['seen']} ({r['accuracy']:.0%})" if r else "-"
        parts.append(table(["Set", *fields], [[r["set_slug"], *[cell(found.get((r["set_slug"], f))) for f in fields]] for r in rows]))
    return "\n".join([*parts, TARGETS])
