"""Operator-level queries: each building block applied to the (derived) source data.

Every query reads catalog tables, so its work grows with the data; none runs on
fixed literal input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..config import ReportConfig
from ..functions import budget as B
from ..operators.context import ambiguous_contexts, arm_value, condensed_context, planning_context, rule_arm
from ..operators.fees import fee_rows, join_fee
from ..operators.reconcile import last_actual_date, reconcile
from . import branding


def planning_context_q(cat, cfg: ReportConfig) -> DataFrame:
    """Condensed context: chosen mapping row and row count per campaign id."""
    return condensed_context(planning_context(cat["planning_context_map"], distinct=False))


def ambiguous_context_q(cat, cfg: ReportConfig) -> DataFrame:
    """Uniqueness report of the planning-context mapping."""
    return ambiguous_contexts(cat["planning_context_map"])


def date_spine_q(cat, cfg: ReportConfig) -> DataFrame:
    """Calendar days spanned by the fix-cost intervals, inside the fix-cost calendar."""
    fx = cat["affiliate_fixcost"].agg(F.min("start_date").alias("lo"), F.max("end_date").alias("hi"))
    lo = F.greatest(F.col("lo"), F.lit(cfg.fixcost_calendar_start))
    hi = F.least(F.col("hi"), F.lit(cfg.fixcost_calendar_end))
    return fx.filter(lo <= hi).select(F.explode(F.sequence(lo, hi)).alias("datum"))


def _campaigns(cat) -> DataFrame:
    return cat["google_keyword_perf"].select("camp_id").distinct()


def budget_logic_q(cat, cfg):
    return _campaigns(cat).select("camp_id", B.budget_logic(F.col("camp_id")).alias("budget_logic"))


def budget_share_q(cat, cfg):
    return B.with_budget(_campaigns(cat))


def budget_logic_reduced_q(cat, cfg):
    return _campaigns(cat).select("camp_id", B.budget_logic_reduced(F.col("camp_id")).alias("budget_logic"))


def budget_share_ws_q(cat, cfg):
    c = _campaigns(cat).withColumn("budget_logic", B.budget_logic(F.col("camp_id")))
    return c.withColumn("budget_logic_share", B.budget_share_ws(F.col("camp_id"), F.col("budget_logic")))


def budget_from_name_q(cat, cfg):
    """Classes from campaign names: TV style (upper-cased first) and radio style (raw)."""
    names = cat["tv_flights"].select(F.col("tv_flight_name").alias("campaign_name")).distinct()
    up = F.upper(F.col("campaign_name"))
    return names.select(
        "campaign_name",
        B.logic_from_name(up).alias("logic_upper"), B.type_from_name(up).alias("type_upper"),
        B.logic_from_name(F.col("campaign_name")).alias("logic_raw"),
        B.type_from_name(F.col("campaign_name")).alias("type_raw"),
    )


def budget_from_attr_q(cat, cfg):
    """Classes from the plan's budget origin, with the class-only share."""
    o = cat["bpn_planning"].select("budget_origin").distinct()
    return o.select(
        "budget_origin", B.logic_from_origin(F.col("budget_origin")).alias("budget_logic"),
        B.type_from_origin(F.col("budget_origin")).alias("campaign_type"),
    ).withColumn("budget_logic_share", B.share_from_class(F.col("budget_logic")))


RULE_SETS = {"gdn": fv.GDN_RULES, "facebook": fv.FACEBOOK_RULES, "pinterest": fv.PINTEREST_RULES,
             "snapchat": fv.SNAPCHAT_RULES, "tiktok": fv.TIKTOK_RULES}


def context_fallback_q(cat, cfg):
    """Fallback planning context of every rule set for each (name, account) pair."""
    pairs = cat["tiktok_ad_perf"].select(F.col("tiktok_campaign_name").alias("campaign_name"),
                                         F.col("tiktok_account_id").alias("account_id")).distinct()
    frames = []
    for rule_set, rules in RULE_SETS.items():
        arm = rule_arm(rules, F.col("campaign_name"), F.col("account_id"), cfg)
        frames.append(pairs.select(
            F.lit(rule_set).alias("rule_set"), "campaign_name", "account_id",
            arm_value(rules, arm, "code").alias("planning_context_code"),
            arm_value(rules, arm, "name").alias("planning_context_name")))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def actual_vs_plan_q(cat, cfg):
    """TV actual against plan rows, before fees and the daily sum."""
    r = reconcile(branding.tv_actuals(cat), branding.plan_rows(cat, ("bra_tv",)).drop("branch"), cfg.branding_min_date,
                  cfg.yesterday)
    return r.select("reporting_date", "budget_logic", "campaign_type", "is_plan",
                    F.col("media_cost").cast("double").alias("media_cost"),
                    F.col("infra_base").cast("double").alias("infra_base"),
                    F.col("impressions").cast("double").alias("impressions"))


def agency_fee_q(cat, cfg):
    """Out-of-home cost rows with the fee row of their month and sub channel."""
    src = cat["dooh_perf"]
    sub = F.when(F.instr(F.upper(F.col("cost_type")), fv.DOOH_PROGRAMMATIC_MARK) > 0, F.lit(fv.DOOH_PROGRAMMATIC)) \
        .otherwise(F.lit(fv.DOOH_PLAIN))
    rows = src.select(F.col("planning_date").cast("date").alias("reporting_date"), sub.alias("sub_channel"),
                      F.col("cost_euro_nnn").cast("double").alias("cost_euro_nnn"))
    fees = fee_rows(cat["agency_fee"], fv.FEE_DOOH, True)
    j = join_fee(rows, "reporting_date", fees, sub_channel=F.upper(F.col("sub_channel")),
                 cols=("fee", "discount", "managed_fee", "dsp_fee"))
    return j.select("reporting_date", "sub_channel", "cost_euro_nnn",
                    *[F.col(c).cast("double").alias(c) for c in ("fee", "discount", "managed_fee", "dsp_fee")])


def effective_media_cost_q(cat, cfg):
    """Digital per (day, scope, id group, channel): booked, effective and capped cost."""
    lvl3 = branding.digital_sums(cat, cfg).withColumnRenamed("datum", "reporting_date")
    capped = F.when(F.col("kosten_nnn_eff") > F.col("kosten_nnn"), F.col("kosten_nnn")).otherwise(F.col("kosten_nnn_eff"))
    return lvl3.select("reporting_date", "campaign_scope", "adgap_ids", "channel", "kosten_nnn", "kosten_nnn_eff",
                       capped.alias("media_cost"), F.col("fee").cast("double").alias("fee"))


def last_actual_date_q(cat, cfg):
    """Per-day TV actuals with the last actual day of their campaign."""
    a = branding.tv_actuals(cat)
    return last_actual_date(a, "a_name").select(
        F.col("a_date").alias("actual_date"), F.col("a_name").alias("campaign_name"), "max_actual_date",
        F.col("a_cost").cast("double").alias("cost"))


BUILDERS = {
    "ambiguous_context": ambiguous_context_q, "planning_context": planning_context_q, "date_spine": date_spine_q, "budget_logic": budget_logic_q,
    "budget_share": budget_share_q, "budget_logic_reduced": budget_logic_reduced_q,
    "budget_share_ws": budget_share_ws_q, "budget_from_name": budget_from_name_q,
    "budget_from_attr": budget_from_attr_q, "context_fallback": context_fallback_q,
    "actual_vs_plan": actual_vs_plan_q, "agency_fee": agency_fee_q,
    "effective_media_cost": effective_media_cost_q, "last_actual_date": last_actual_date_q,
}
