"""Day x campaign rollup of ad-platform facts (the channel-view branch shape).

scan -> filters (pushed to Parquet) -> hash aggregate by (reporting_date,
camp_id) with map-side partial sums -> join of the aggregated rows to the
condensed planning context -> lineage label.

The only shuffle is the aggregation's exchange on (reporting_date, camp_id);
the context join runs on aggregated rows against a size-checked broadcast. A
campaign id holding a third of all rows (NULL is the usual one) is absorbed by
the partial aggregation: every map task emits one row per (day, campaign).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .context import CLASS_COLUMNS, Fallback, enrich


def activity(cols: list[Column], strict: bool) -> Column:
    """Sum of the coalesced metrics ``> 0`` (strict) or ``!= 0`` (loose)."""
    total = None
    for c in cols:
        term = F.coalesce(c, F.lit(0))
        total = term if total is None else total + term
    return total > 0 if strict else total != 0


@dataclass(frozen=True)
class Branch:
    """A channel-view branch: standardized facts and how their sums become report rows.

    ``facts`` has reporting_date, camp_id, impressions, clicks (unless ``clicks == 'zero'``), cost_euro and,
    for rule fallbacks, ``_arm``. ``clicks``: 'sum', 'sum_or_zero' (COALESCE(SUM, 0)) or 'zero' (constant).
    """

    facts: DataFrame
    fallback: Fallback
    label: str
    clicks: str = "sum"


SUM_COLUMNS = ("impressions", "clicks", "cost_euro", "_arm")


def day_sums(branch: Branch) -> DataFrame:
    """The facts summed per day and campaign: reporting_date, camp_id and what the branch has of SUM_COLUMNS.

    Mergeable: sums of parts, added up by ``merged_sums``, are the sums of the whole.
    """
    have = branch.facts.columns
    aggs = [F.sum(c).alias(c) for c in SUM_COLUMNS[:3] if c in have]
    if branch.fallback.rules is not None:
        aggs.append(F.min("_arm").alias("_arm"))
    return branch.facts.groupBy("reporting_date", "camp_id").agg(*aggs)


def merged_sums(sums: DataFrame, *keys: str) -> DataFrame:
    """Day sums of several parts of the facts, per ``keys``, day and campaign."""
    return sums.groupBy(*keys, "reporting_date", "camp_id").agg(
        *[(F.min if c == "_arm" else F.sum)(c).alias(c) for c in SUM_COLUMNS if c in sums.columns])


def view_rows(sums: DataFrame, ctx_small: DataFrame, branch: Branch) -> DataFrame:
    """Report rows of a branch from its day sums and the planning context.

    Metrics stay exact (BIGINT, DECIMAL); callers cast money at the end. Where ``ctx_small`` is the
    campaign dimension, the campaign's classes come along.
    """
    e = enrich(sums, ctx_small, branch.fallback)
    n = F.col("ctx_rows")
    if branch.clicks == "zero":
        clicks_col = F.lit(0).cast("bigint")
    elif branch.clicks == "sum_or_zero":
        clicks_col = F.coalesce(F.col("clicks") * n, F.lit(0).cast("bigint"))
    else:
        clicks_col = F.col("clicks") * n
    return e.select(
        "reporting_date", "planning_context_code", "planning_context_name", "channel", "camp_id",
        F.lit(branch.label).alias("source_system"),
        (F.col("impressions") * n).cast("bigint").alias("impressions"),
        clicks_col.cast("bigint").alias("clicks"),
        (F.col("cost_euro") * n).alias("cost_euro"),
        *[c for c in CLASS_COLUMNS if c in ctx_small.columns],
    )


def rollup(facts: DataFrame, ctx_small: DataFrame, fb: Fallback, label: str, *, clicks: str = "sum") -> DataFrame:
    """Aggregate standardized facts and enrich them with the planning context (see ``Branch``)."""
    branch = Branch(facts, fb, label, clicks)
    return view_rows(day_sums(branch), ctx_small, branch)


def money_to_double(df: DataFrame, cols=("cost_euro",)) -> DataFrame:
    """Cast exact money columns to DOUBLE as the last step of a report."""
    return df.withColumns({c: F.col(c).cast("double") for c in cols if c in df.columns})
