"""Social-ads cost view: five platforms, one row per day and campaign."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..config import ReportConfig
from ..functions.text import has, has_upper, lacks
from ..operators.context import Fallback, rule_arm
from ..operators.rollup import Branch, activity, day_sums, view_rows
from .common import campaigns_for, channel_view, context_for, label

KEYS = ("soc_facebook", "soc_pinterest", "soc_snapchat", "soc_youtube", "soc_tiktok")


def context(cat, cfg: ReportConfig) -> DataFrame:
    return context_for(cat, cfg, distinct=False)


def social_marked(camp: str, name: str):
    """Social campaign: ``-SA.C-`` in the id or PERFORMANCE in the name."""
    return has(F.col(camp), fv.SOCIAL_MARK) | has_upper(F.col(name), fv.PERFORMANCE)


def facebook(cat, cfg) -> Branch:
    dat = (cat["facebook_ad_perf"]
           .filter(F.col("reporting_date") >= F.lit(cfg.min_date))
           .filter(social_marked("camp_id", "facebook_campaign_name"))
           .filter(activity([F.col("impressions"), F.col("cost_euro"), F.col("clicks")], strict=True))
           .filter(~F.col("facebook_account_id").isin(list(cfg.facebook_excluded_accounts))))
    facts = dat.select("reporting_date", "camp_id", "impressions", "clicks", "cost_euro",
                       rule_arm(fv.FACEBOOK_RULES, F.col("facebook_campaign_name"), None, cfg).alias("_arm"))
    return Branch(facts, Fallback(fv.CH_SOCIAL, rules=fv.FACEBOOK_RULES), label(cfg, fv.SRC_FACEBOOK))


def pinterest(cat, cfg) -> Branch:
    dat = (cat["pinterest_pin_perf"]
           .filter(F.col("reporting_date") >= F.lit(cfg.min_date))
           .filter(activity([F.col("impressions_paid"), F.col("cost_euro"), F.col("clicks_paid")], strict=True))
           .filter(social_marked("camp_id", "pinterest_campaign_name")))
    facts = dat.select("reporting_date", "camp_id", F.col("impressions_paid").alias("impressions"),
                       F.col("clicks_paid").alias("clicks"), "cost_euro",
                       rule_arm(fv.PINTEREST_RULES, F.col("pinterest_campaign_name"), None, cfg).alias("_arm"))
    return Branch(facts, Fallback(fv.CH_SOCIAL, rules=fv.PINTEREST_RULES), label(cfg, fv.SRC_PINTEREST))


def snapchat(cat, cfg) -> Branch:
    dat = (cat["snap_ad_perf"]
           .filter(F.col("reporting_date") >= F.lit(cfg.min_date))
           .filter(activity([F.col("impressions"), F.col("cost_euro")], strict=True))
           .filter(social_marked("camp_id", "snap_campaign_name")))
    facts = dat.select("reporting_date", "camp_id", "impressions", "cost_euro",
                       rule_arm(fv.SNAPCHAT_RULES, F.col("snap_campaign_name"), None, cfg).alias("_arm"))
    return Branch(facts, Fallback(fv.CH_SOCIAL, rules=fv.SNAPCHAT_RULES), label(cfg, fv.SRC_SNAPCHAT),
                  clicks="zero")


def youtube(cat, cfg) -> Branch:
    name = F.col("google_campaign_name")
    dat = (cat["google_ad_perf"]
           .filter(F.col("date_col") >= F.lit(cfg.min_date))
           .filter(activity([F.col("impressions"), F.col("cost_euro"), F.col("clicks")], strict=True))
           .filter(F.col("google_account_id").isin(list(cfg.youtube_accounts)))
           .filter(has(F.col("camp_id"), fv.SOCIAL_MARK) | has_upper(name, fv.PERFORMANCE) | has_upper(name, fv.WKZ)))
    facts = dat.select(F.col("date_col").alias("reporting_date"), "camp_id", "impressions", "clicks", "cost_euro")
    code, nm = fv.PC_YOUTUBE
    return Branch(facts, Fallback(fv.CH_SOCIAL, code, nm), label(cfg, fv.SRC_GOOGLE_AD))


def tiktok(cat, cfg) -> Branch:
    dat = (cat["tiktok_ad_perf"]
           .filter(F.col("reporting_date") >= F.lit(cfg.min_date))
           .filter(activity([F.col("impressions"), F.col("cost_euro"), F.col("clicks")], strict=True))
           .filter(social_marked("camp_id", "tiktok_campaign_name")))
    facts = dat.select("reporting_date", "camp_id", "impressions", "clicks", "cost_euro",
                       rule_arm(fv.TIKTOK_RULES, F.col("tiktok_campaign_name"), F.col("tiktok_account_id"), cfg)
                       .alias("_arm"))
    return Branch(facts, Fallback(fv.CH_SOCIAL, rules=fv.TIKTOK_RULES), label(cfg, fv.SRC_TIKTOK))


FACTS = {"soc_facebook": (facebook, "facebook_ad_perf"), "soc_pinterest": (pinterest, "pinterest_pin_perf"),
         "soc_snapchat": (snapchat, "snap_ad_perf"), "soc_youtube": (youtube, "google_ad_perf"),
         "soc_tiktok": (tiktok, "tiktok_ad_perf")}


def facts(cat, cfg: ReportConfig, key: str) -> Branch:
    """A branch's standardized facts and what becomes of their sums."""
    return FACTS[key][0](cat, cfg)


def branch(cat, cfg: ReportConfig, key: str, ctx: DataFrame | None = None) -> DataFrame:
    b = facts(cat, cfg, key)
    return view_rows(day_sums(b), context(cat, cfg) if ctx is None else ctx, b)


def view(branches: list[DataFrame]) -> DataFrame:
    """The report of its branches' rows: NULL camp_id is kept in this view."""
    return channel_view(branches).filter(lacks(F.col("camp_id"), fv.SOCIAL_EXCLUDE_MARK) | F.col("camp_id").isNull())


def report(cat, cfg: ReportConfig) -> DataFrame:
    ctx = campaigns_for(cat, distinct=False)
    return view([branch(cat, cfg, k, ctx) for k in KEYS])
