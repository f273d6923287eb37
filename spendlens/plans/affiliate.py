"""Affiliate cost and click view.

Four row-level branches (provisions AWIN, provisions private network, fix
costs spread over days, tracked clicks) are unioned and summed per day,
planning context, channel, campaign and source.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..config import ReportConfig
from ..functions.budget import with_budget
from ..operators.context import CLASS_COLUMNS, planning_context
from ..operators.spread import explode_days, running_days, running_spans
from .common import CHANNEL_VIEW, campaigns_for, label, union_all

KEYS = ("aff_awin_cost", "aff_private_network_cost", "aff_fixcost_daily", "aff_clicks")


def context(cat, cfg: ReportConfig) -> DataFrame:
    """The affiliate context is DISTINCT and joined row by row (no FIRST_VALUE here)."""
    return planning_context(cat["planning_context_map"], distinct=True)


def in_window(c, cfg: ReportConfig):
    return c.between(F.lit(cfg.affiliate_from), F.lit(cfg.as_of))


def _with_context(rows: DataFrame, ctx: DataFrame, code: str | None, name: str | None, how: str = "left") -> DataFrame:
    c = ctx.select(F.col("camp_id").alias("_ctx_camp"), F.col("planning_context_code").alias("_code"),
                   F.col("planning_context_name").alias("_name"))
    j = rows.join(c, rows["camp_id"] == c["_ctx_camp"], how)
    code_c = F.coalesce(F.col("_code"), F.lit(code)) if code is not None else F.col("_code")
    name_c = F.coalesce(F.col("_name"), F.lit(name)) if name is not None else F.col("_name")
    return j.withColumn("planning_context_code", code_c).withColumn("planning_context_name", name_c)


def _provisions(cat, cfg: ReportConfig, source: str, cost: Column) -> DataFrame:
    """Non-zero provisions of the look-back window on the day of their order."""
    return (cat.days(source, cfg.affiliate_from, cfg.as_of)
            .select(F.to_date("order_timestamp").alias("reporting_date"), "camp_id", cost.alias("cost"))
            .filter(F.col("cost") != 0)
            .filter(in_window(F.col("reporting_date"), cfg)))


def awin_cost(cat, cfg):
    return _provisions(cat, cfg, "affiliate_costs_awin", F.col("nw_provision_hr") + F.col("nw_networkfee_hr"))


def private_network_cost(cat, cfg):
    return _provisions(cat, cfg, "affiliate_costs_private_network", F.col("nw_provision_hr"))


def _fixcosts(cat, cfg: ReportConfig):
    """Fix costs with their cost per day, and the days that count: calendar and look-back window.

    A zero duration gives NULL, so such rows keep their days with a NULL cost. The
    quotient is a DECIMAL: sums do not depend on the order of the rows.
    """
    src = cat["affiliate_fixcost"].filter(F.col("additional_costs") == "true")
    per_day = (F.col("cost_euro").cast("decimal(18,2)")
               / F.nullif(F.col("duration_in_days"), F.lit(0)).cast("decimal(10,0)"))
    rows = src.select(F.col("campaign").alias("camp_id"), "start_date", "end_date", per_day.alias("cost"))
    return rows, max(cfg.fixcost_calendar_start, cfg.affiliate_from), min(cfg.fixcost_calendar_end, cfg.as_of)


def fixcost_daily(cat, cfg):
    """Fix costs spread evenly over their days: a row per cost and day."""
    rows, lo, hi = _fixcosts(cat, cfg)
    return explode_days(rows, "start_date", "end_date", lo, hi, out="reporting_date").select(
        "reporting_date", "camp_id", "cost")


def fixcost_sums(cat, cfg):
    """The same summed per day and campaign, from two changes per cost instead of a row per day."""
    rows, lo, hi = _fixcosts(cat, cfg)
    return running_days(rows, ["camp_id"], "start_date", "end_date", lo, hi, {"cost": F.col("cost")},
                        out="reporting_date").select("reporting_date", "camp_id", "cost", F.lit(0).cast("bigint").alias("clicks"))


def fixcost_spans(cat, cfg):
    """The same per campaign and span of days with the same sum, as an array."""
    rows, lo, hi = _fixcosts(cat, cfg)
    return running_spans(rows, ["camp_id"], "start_date", "end_date", lo, hi, {"cost": F.col("cost")}).select(
        F.sequence("first_day", "last_day").alias("days"), "camp_id", "cost", F.lit(0).cast("bigint").alias("clicks"))


def _ts_lit(day: dt.date):
    return F.lit(f"{day.isoformat()} 00:00:00").cast("timestamp_ntz")


def cet_date(ts):
    """Calendar day in CET (summer time applies) of a UTC timestamp."""
    return F.to_date(F.convert_timezone(F.lit("UTC"), F.lit("CET"), ts.cast("timestamp_ntz")))


def _linked_calls(cat, cfg: ReportConfig) -> tuple[DataFrame, DataFrame]:
    """Calls without bots on their CET day with their campaign key; and the hub rows of the two named contexts.

    The one fact-to-fact join is on the call key, unique per call. Where both facts are tables
    bucketed by it (``Catalog.colocated``), they are joined bucket by bucket and neither moves.
    Otherwise the hub cuts the link first, so the shuffle carries affiliate links only. A plain range
    on the raw UTC timestamp (one day of margin for the CET offset) prunes day partitions and row
    groups before the exact CET-day test.
    """
    ts = F.col("event_created_at_utc")
    before = cfg.affiliate_from - dt.timedelta(days=1)
    calls = (cat.days("tracking_calls", before, cfg.as_of)
             .filter(ts >= _ts_lit(before))
             .filter(ts < _ts_lit(cfg.as_of + dt.timedelta(days=1)))
             .filter(F.col("bot") == F.lit(False))
             .select("external_call_h_sk", cet_date(ts).alias("reporting_date"))
             .filter(in_window(F.col("reporting_date"), cfg)))
    named = click_context(context(cat, cfg)).select(F.col("camp_id").alias("_named"))
    hub = (cat["campaign_hub"].select("campaign_h_sk", F.col("campaign_id").alias("camp_id"))
           .join(named, F.col("camp_id") == F.col("_named"), "left_semi"))
    link = cat["tracking_call_campaign_link"].select("external_call_h_sk", "campaign_h_sk")
    if not cat.colocated("tracking_calls", "tracking_call_campaign_link"):
        link = link.join(hub.select("campaign_h_sk"), "campaign_h_sk", "left_semi")
    return calls.join(link, "external_call_h_sk").select("reporting_date", "campaign_h_sk"), hub


def clicks(cat, cfg):
    """Tracked calls of campaigns in the two named contexts, a row per call and campaign."""
    calls, hub = _linked_calls(cat, cfg)
    return calls.join(hub, "campaign_h_sk").select("reporting_date", "camp_id", F.lit(0).cast("decimal(18,2)").alias("cost"))


def click_sums(cat, cfg):
    """The same counted per day and campaign: calls are counted per campaign key before they meet the hub."""
    calls, hub = _linked_calls(cat, cfg)
    counted = calls.groupBy("reporting_date", "campaign_h_sk").agg(F.count(F.lit(1)).alias("clicks"))
    return (counted.join(hub, "campaign_h_sk").groupBy("reporting_date", "camp_id")
            .agg(F.lit(0).cast("decimal(18,2)").alias("cost"), F.sum("clicks").alias("clicks")))


def click_context(ctx: DataFrame) -> DataFrame:
    return ctx.filter(F.col("planning_context_name").isin(list(fv.AFF_CLICK_CONTEXT_NAMES)))


def _summed(rows):
    """Sums per day and campaign of a branch's rows: combined map-side before any join."""
    return lambda cat, cfg: rows(cat, cfg).groupBy("reporting_date", "camp_id").agg(
        F.sum("cost").alias("cost"), F.lit(0).cast("bigint").alias("clicks"))


# branch: rows, their sums per day and campaign, source, fallback context, clicks of a row
BRANCHES = {
    "aff_awin_cost": (awin_cost, _summed(awin_cost), fv.SRC_AFF_AWIN, fv.PC_AWIN, 0),
    "aff_private_network_cost": (private_network_cost, _summed(private_network_cost), fv.SRC_AFF_PRIVATE_NETWORK,
                                 fv.PC_PRIVATE_NETWORK, 0),
    "aff_fixcost_daily": (fixcost_daily, fixcost_sums, fv.SRC_AFF_FIXCOST, fv.PC_PRIVATE_NETWORK, 0),
    "aff_clicks": (clicks, click_sums, fv.SRC_AFF_CLICKS, None, 1),
}


def _in_context(cfg: ReportConfig, key: str, rows: DataFrame, ctx: DataFrame) -> DataFrame:
    """rows (reporting_date, camp_id, clicks, cost) with their context, in view columns."""
    _, _, source, fallback, _ = BRANCHES[key]
    if fallback is None:
        j = _with_context(rows, click_context(ctx), None, None, how="inner")
    else:
        j = _with_context(rows, ctx, *fallback)
    return j.select(
        "reporting_date", "planning_context_code", "planning_context_name",
        F.lit(fv.CH_AFFILIATES).alias("channel"), "camp_id", F.lit(label(cfg, source)).alias("source_system"),
        F.lit(0).cast("bigint").alias("impressions"), F.col("clicks").cast("bigint").alias("clicks"),
        F.col("cost").alias("cost_euro"))


def branch(cat, cfg: ReportConfig, key: str, ctx: DataFrame | None = None) -> DataFrame:
    """A branch's single rows."""
    rows, _, _, _, clicks_each = BRANCHES[key]
    return _in_context(cfg, key, rows(cat, cfg).withColumn("clicks", F.lit(clicks_each)),
                       context(cat, cfg) if ctx is None else ctx)


def _repeated(cost: Column, n: Column) -> Column:
    """n times a sum: exact where it fits, as the product of wide DECIMALs loses digits of the fraction."""
    return F.coalesce(cost.try_cast("decimal(27,13)") * n.cast("decimal(10,0)"), (cost * n).cast("decimal(38,13)"))


def _summed_in_context(cfg: ReportConfig, key: str, sums: DataFrame, ctx: DataFrame) -> DataFrame:
    """Sums per campaign and day, or span of days, once per context of the campaign: report rows.

    Mapping rows that differ in their channel only repeat a sum; they are counted on the mapping's side.
    """
    _, _, source, fallback, _ = BRANCHES[key]
    code, name = F.col("planning_context_code"), F.col("planning_context_name")
    if fallback is not None:
        code, name = F.coalesce(code, F.lit(fallback[0])), F.coalesce(name, F.lit(fallback[1]))
    contexts = ((click_context(ctx) if fallback is None else ctx).filter(F.col("camp_id").isNotNull())
                .groupBy(F.col("camp_id").alias("_ctx_camp"), code.alias("_code"), name.alias("_name"))
                .agg(F.count(F.lit(1)).cast("int").alias("_rows")))
    j = sums.join(contexts, sums["camp_id"] == contexts["_ctx_camp"], "inner" if fallback is None else "left")
    n = F.coalesce(F.col("_rows"), F.lit(1))
    unmapped = fallback or (None, None)
    return j.select(
        *[c for c in ("reporting_date", "days") if c in sums.columns],
        F.when(F.col("_rows").isNull(), F.lit(unmapped[0])).otherwise(F.col("_code")).alias("planning_context_code"),
        F.when(F.col("_rows").isNull(), F.lit(unmapped[1])).otherwise(F.col("_name")).alias("planning_context_name"),
        F.lit(fv.CH_AFFILIATES).alias("channel"), "camp_id", F.lit(label(cfg, source)).alias("source_system"),
        F.lit(0).cast("bigint").alias("impressions"), (F.col("clicks") * n).cast("bigint").alias("clicks"),
        _repeated(F.col("cost"), n).alias("cost_euro"))


def report(cat, cfg: ReportConfig) -> DataFrame:
    """Sums per day, context, channel, campaign and source.

    Each branch is summed per (day, campaign) first, so the context meets sums, not
    raw rows: a campaign of many rows (or none at all, the NULL key) is combined
    map-side before any join. The branches differ in their source and the contexts are counted,
    so nothing is summed after the joins. Fix costs meet the dimensions as spans; their days come last.
    """
    ctx = context(cat, cfg)
    classes = campaigns_for(cat, distinct=True).select("camp_id", *CLASS_COLUMNS)
    parts = []
    for key, (_, sums, *_) in BRANCHES.items():
        rows = fixcost_spans(cat, cfg) if key == "aff_fixcost_daily" else sums(cat, cfg)
        part = _summed_in_context(cfg, key, rows, ctx).join(classes, "camp_id", "left")
        if key == "aff_fixcost_daily":
            part = part.withColumn("reporting_date", F.explode("days")).drop("days")
        parts.append(part)
    return with_budget(union_all(parts)).select(*CHANNEL_VIEW).withColumn("cost_euro", F.col("cost_euro").cast("double"))
