"""Planning-context lookup and enrichment.

The reference left-joins every fact row to the campaign -> planning-context
mapping and then takes ``FIRST_VALUE`` of the (coalesced) context columns per
day and campaign. Two things make that expensive or ill-defined at scale:

* ``FIRST_VALUE`` without an order is "any row"; after a shuffle it is not
  reproducible. Here the choice is made deterministic: the first mapping row in
  (channel, code, name) order with NULLs last, then the first matching fallback
  rule arm (lowest arm index).
* joining the raw fact to the mapping multiplies rows before aggregation.
  Because ``camp_id`` is a grouping key, the join can move after the
  aggregation: each mapping row of a campaign repeats the campaign's sums, so
  the sums are multiplied by the mapping's row count per ``camp_id``.

A ``min`` over a string struct would force a sort-based aggregate; the rule arm
is an INT, so the rollup stays a hash aggregate with map-side partial sums.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import ReportConfig
from ..functions.budget import budget_logic, budget_share
from ..functions.text import has, lacks

CTX_COLUMNS = ("channel", "planning_context_code", "planning_context_name")


def planning_context(mapping: DataFrame, distinct: bool = False) -> DataFrame:
    """The context CTE: channel, code, name, camp_id (deduplicated where the report does)."""
    ctx = mapping.select(
        F.col("channel_name").alias("channel"), "planning_context_code", "planning_context_name", "camp_id")
    return ctx.distinct() if distinct else ctx


def condensed_context(ctx: DataFrame) -> DataFrame:
    """One row per non-NULL camp_id: the chosen mapping row plus ``ctx_rows``.

    The chosen row is the smallest (channel, code, name) with NULLs last: a
    ``min`` over a struct of (is-NULL flag, value) pairs, computed with partial
    aggregation, so a campaign id holding a large share of the mapping is
    combined map-side instead of landing whole in one task. NULL keys never
    match an equi join and are dropped first.
    """
    keyed = ctx.filter(F.col("camp_id").isNotNull())
    fields = []
    for c in CTX_COLUMNS:
        fields += [F.col(c).isNull().alias(f"{c}_null"), F.col(c).alias(c)]
    return (
        keyed.groupBy("camp_id")
        .agg(F.count(F.lit(1)).cast("int").alias("ctx_rows"), F.min(F.struct(*fields)).alias("_first"))
        .select("camp_id", *[F.col(f"_first.{c}").alias(c) for c in CTX_COLUMNS], "ctx_rows")
    )


#: Columns of the campaign dimension beside the condensed context's: budget class and share.
CLASS_COLUMNS = ("campaign_logic", "campaign_share")


def campaign_dimension(ctx: DataFrame, campaigns: DataFrame) -> DataFrame:
    """The condensed context of all campaigns known from the mapping or the campaign table, with their budget classes.

    Markers are searched once per campaign here, not once per day and campaign in a report's rows.
    ``campaigns`` has campaign_id; a campaign without mapping rows has NULL context and ``ctx_rows`` 0.
    """
    keyed = ctx.filter(F.col("camp_id").isNotNull()).select("camp_id", *CTX_COLUMNS, F.lit(1).alias("_mapped"))
    others = campaigns.filter(F.col("campaign_id").isNotNull()).select(
        F.col("campaign_id").alias("camp_id"), *[F.lit(None).cast("string").alias(c) for c in CTX_COLUMNS], F.lit(0).alias("_mapped"))
    fields = []
    for c in CTX_COLUMNS:
        fields += [F.col(c).isNull().alias(f"{c}_null"), F.col(c).alias(c)]
    logic = budget_logic(F.col("camp_id"))
    return (
        keyed.unionAll(others).groupBy("camp_id")
        .agg(F.sum("_mapped").cast("int").alias("ctx_rows"),
             F.min(F.when(F.col("_mapped") == 1, F.struct(*fields))).alias("_first"))
        .select("camp_id", *[F.col(f"_first.{c}").alias(c) for c in CTX_COLUMNS], "ctx_rows", logic.alias("campaign_logic"))
        .withColumn("campaign_share", budget_share(F.col("camp_id"), F.col("campaign_logic")))
    )


def ambiguous_contexts(mapping: DataFrame) -> DataFrame:
    """Campaign ids with several mapping rows: their facts count once per row, so this is worth a look."""
    return (planning_context(mapping).filter(F.col("camp_id").isNotNull()).groupBy("camp_id")
            .agg(F.count(F.lit(1)).alias("mapping_rows"),
                 F.count_distinct(F.struct(*[F.coalesce(F.col(c), F.lit("")) for c in CTX_COLUMNS])).alias("contexts"))
            .filter(F.col("mapping_rows") > 1))


@dataclass(frozen=True)
class Fallback:
    """What a branch puts where the mapping has no value.

    ``code``/``name`` are constants, or ``rules`` is a rule table (see
    fixed_values) evaluated per fact row; with neither, code and name stay NULL.
    """

    channel: str
    code: str | None = None
    name: str | None = None
    rules: dict | None = None


def rule_arm(rules: dict, name: Column, account: Column | None, cfg: ReportConfig) -> Column:
    """Index of the first matching rule arm, ``len(arms)`` when none matches."""
    text = F.upper(name) if rules["upper"] else name
    expr = None
    for i, arm in enumerate(rules["arms"]):
        cond = None
        for m in arm.get("has", ()):
            cond = has(text, m) if cond is None else cond & has(text, m)
        for m in arm.get("lacks", ()):
            cond = lacks(text, m) if cond is None else cond & lacks(text, m)
        accounts = [getattr(cfg, a) for a in arm.get("accounts", ())]
        if accounts:
            hit = account.isin(accounts)
            cond = hit if cond is None else cond | hit
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return expr.otherwise(F.lit(len(rules["arms"])))


def arm_value(rules: dict, arm: Column, field: str) -> Column:
    """The arm's constant ``field`` ('code' or 'name'); NULL for 'no match'."""
    expr = None
    for i, a in enumerate(rules["arms"]):
        expr = F.when(arm == i, F.lit(a[field])) if expr is None else expr.when(arm == i, F.lit(a[field]))
    return expr


def enrich(df: DataFrame, ctx_small: DataFrame, fb: Fallback, arm_col: str = "_arm") -> DataFrame:
    """Left join the condensed context on camp_id; coalesce with the fallback.

    Returns df's columns plus channel, planning_context_code,
    planning_context_name and ``ctx_rows`` (1 where the mapping has no row).
    """
    j = df.join(ctx_small, "camp_id", "left")
    if fb.rules is not None:
        code = F.coalesce(F.col("planning_context_code"), arm_value(fb.rules, F.col(arm_col), "code"))
        name = F.coalesce(F.col("planning_context_name"), arm_value(fb.rules, F.col(arm_col), "name"))
    elif fb.code is not None:
        code = F.coalesce(F.col("planning_context_code"), F.lit(fb.code))
        name = F.coalesce(F.col("planning_context_name"), F.lit(fb.name))
    else:
        code, name = F.col("planning_context_code"), F.col("planning_context_name")
    return (
        j.withColumn("channel", F.coalesce(F.col("channel"), F.lit(fb.channel)))
        .withColumn("planning_context_code", code)
        .withColumn("planning_context_name", name)
        .withColumn("ctx_rows", F.greatest(F.coalesce(F.col("ctx_rows"), F.lit(1)), F.lit(1)))
    )
