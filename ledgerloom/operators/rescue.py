"""The review queue: failed extractions that were not pushed, and their deadline."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.money import business_days

# The plan whose tenants' failures are reviewed, rows that an alert lists, and that its result carries.
PLAN, LISTED, CARRIED = "rescue_export", 30, 10


def pending(extractions: DataFrame, pushed: DataFrame, tenants: DataFrame | None = None, plan: str = PLAN) -> DataFrame:
    """Failed extractions (id, tenant_id, gate_passed, created_at) without a marker in pushed (target_id), oldest first.

    With tenants (tenant_id, plan, suppressed) only those of a plan that are not suppressed. One join for all tenants.
    """
    failed = extractions.filter(~F.col("gate_passed"))
    if tenants is not None:
        failed = failed.join(tenants.filter((F.col("plan") == plan) & ~F.col("suppressed")).select("tenant_id"), "tenant_id")
    marked = pushed.select(F.col("target_id").cast("string").alias("target_id"))
    return failed.join(marked, F.col("id").cast("string") == F.col("target_id"), "left_anti").orderBy("created_at", "id")


def with_age(queue: DataFrame, as_of: Column, limit_days: int = 3) -> DataFrame:
    """Business days in the queue, and whether they are more than the limit."""
    days = business_days(F.to_date("created_at"), as_of)
    return queue.withColumn("business_days", days).withColumn("overdue", F.col("business_days") > limit_days)


def with_project(queue: DataFrame, tenants: DataFrame, projects: DataFrame, prefix: str) -> DataFrame:
    """The queue with the review project of each tenant (tenant_id, slug), found by its name, prefix and slug; tenants without one leave.

    Of projects (project_id, name) with one name the smallest id counts.
    """
    named = projects.groupBy("name").agg(F.min("project_id").alias("project_id"))
    of = tenants.select("tenant_id", F.concat(F.lit(prefix), F.col("slug")).alias("name")).join(named, "name").drop("name")
    return queue.join(of, "tenant_id")


def overdue_alert(extractions: DataFrame, tenants: DataFrame, as_of: Column, limit_days: int = 3, plan: str = PLAN, listed: int = LISTED, carried: int = CARRIED) -> DataFrame:
    """The first `listed` overdue failures of a plan's tenants, oldest first, with their place, whether the result carries them, and how many there are.

    A marker that something was pushed does not end its wait; passing the gate does.
    """
    none = extractions.select(F.col("id").alias("target_id")).limit(0)
    late = with_age(pending(extractions, none, tenants, plan), as_of, limit_days).filter("overdue")
    first = late.orderBy("created_at", "id").limit(listed)
    place = F.row_number().over(Window.orderBy("created_at", "id"))  # `listed` rows
    count = late.agg(F.count(F.lit(1)).alias("n_overdue"))
    return first.withColumn("place", place).withColumn("carried", F.col("place") <= carried).crossJoin(F.broadcast(count))  # one row


def alert_text(rows: list, limit_days: int = 3) -> str:
    """The alert's message from overdue_alert()'s rows (tenant_id, id, business_days, place, n_overdue); empty without any."""
    if not rows:
        return ""
    n = rows[0]["n_overdue"]
    lines = [f"{n} extraction(s) past {limit_days} business days:", "", *[f"  - [{r['tenant_id']}] {r['id']}: {r['business_days']} business days" for r in sorted(rows, key=lambda r: r["place"])]]
    return "\n".join([*lines, *([f"and {n - len(rows)} more"] if n > len(rows) else [])]) + "\n"
