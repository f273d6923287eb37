"""Actual against plan (broadcast media): actual where an actual row exists, else plan.

As written, the reference builds a day calendar, LEFT JOINs the per-day actuals
to it, FULL OUTER JOINs the per-day plan on (day, campaign) and keeps rows whose
actual or plan day falls in the report window; a window value (last actual day
per campaign) decides between actual and plan.

Rewrite (checked against the as-written oracle):
* the calendar only restricts actual days to a range that contains the report
  window, and a plan row can only match an actual row of the same day, so the
  calendar is dropped and the window is pushed into both join inputs;
* ``plan_date <= max_actual_date OR plan_date IS NULL`` is true exactly when the
  row has an actual side (the window value is NULL on plan-only rows, and the
  matched plan day equals an actual day of that campaign), so no window is needed.

Cost and volume take the actual value on matched rows (even if NULL), the
infrastructure base is ``coalesce(actual, plan)``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def reconcile(actual: DataFrame, plan: DataFrame, lo: dt.date, hi: dt.date,
              by: tuple[str, ...] = ()) -> DataFrame:
    """Full outer join of per-day actual and plan rows inside [lo, hi]; ``by``: further columns of both to join on.

    actual: a_date, a_name, a_logic, a_type, a_cost, a_volume
    plan:   p_date, p_name, p_logic, p_type, p_cost, p_volume
    Returns reporting_date, budget_logic, campaign_type, is_plan, media_cost,
    infra_base, impressions (one row per joined pair, as the reference).
    """
    a = actual.filter(F.col("a_date").between(F.lit(lo), F.lit(hi)))
    p = plan.filter(F.col("p_date").between(F.lit(lo), F.lit(hi)))
    p = p.withColumnsRenamed({c: f"_p_{c}" for c in by})
    on = (F.col("a_date") == F.col("p_date")) & (F.col("a_name") == F.col("p_name"))
    for c in by:
        on = on & (F.col(c) == F.col(f"_p_{c}"))
    j = a.join(p, on, "full_outer")
    has_actual = F.col("a_date").isNotNull()
    return j.select(
        *[F.coalesce(c, f"_p_{c}").alias(c) for c in by],
        F.coalesce("a_date", "p_date").alias("reporting_date"),
        F.coalesce("a_logic", "p_logic").alias("budget_logic"),
        F.coalesce("a_type", "p_type").alias("campaign_type"),
        (~has_actual).alias("is_plan"),
        F.when(has_actual, F.col("a_cost")).otherwise(F.col("p_cost")).alias("media_cost"),
        F.coalesce("a_cost", "p_cost").alias("infra_base"),
        F.when(has_actual, F.col("a_volume")).otherwise(F.col("p_volume")).alias("impressions"),
    )


def last_actual_date(actual: DataFrame, partition: str) -> DataFrame:
    """``MAX(day) OVER (PARTITION BY campaign)`` on the per-day actual rows.

    The input holds one row per campaign, day and class (aggregated with partial
    sums), so a window partition is bounded by the calendar however many fact rows
    a campaign has, and the fact is read once.
    """
    return actual.withColumn("max_actual_date", F.max("a_date").over(Window.partitionBy(partition)))
