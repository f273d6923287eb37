"""Display-ads cost view: six sources, one row per day and campaign."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..config import ReportConfig
from ..operators.context import Fallback, rule_arm
from ..operators.islands import day_islands
from ..operators.rollup import Branch, activity, rollup, view_rows
from .common import campaigns_for, channel_view, context_for, label

KEYS = ("dis_adition", "dis_adition_partner", "dis_google_ace", "dis_gdn", "dis_odin", "dis_bing_audience")


def context(cat, cfg: ReportConfig) -> DataFrame:
    return context_for(cat, cfg, distinct=True)


def _valid_idents(cat, cfg: ReportConfig) -> DataFrame:
    """Banner -> campaign rows still known after tomorrow, without the '-1' unknowns.

    The reference filters ``CAMPAIGN_ID != '-1'`` after a LEFT JOIN, which also
    drops unmatched rows: the join is inner.
    """
    until = F.lit(cfg.as_of + dt.timedelta(days=1)).cast("timestamp_ntz")
    return (cat["adition_ad_identifier_map"]
            .filter(F.col("banner_known_until_utc") > until)
            .filter(F.col("campaign_id") != "-1")
            .select("bid", "campaign_id"))


def _metrics(df, imp, clicks, cost):
    return [F.col(imp).alias("impressions"), F.col(clicks).alias("clicks"), F.col(cost).alias("cost_euro")]


def adition(cat, cfg, ctx):
    dat = cat["adition_display_perf"].filter(F.col("business_date") >= F.lit(cfg.min_date)).filter(
        activity([F.col("dsp_impressions_bidon"), F.col("dsp_costs"), F.col("dsp_clicks")], strict=False))
    # summed per (day, banner) before it meets the banners
    daily = dat.groupBy(F.col("business_date").alias("reporting_date"), "bid").agg(
        F.sum("dsp_impressions_bidon").alias("impressions"), F.sum("dsp_clicks").alias("clicks"),
        F.sum("dsp_costs").alias("cost_euro"))
    facts = daily.join(_valid_idents(cat, cfg), "bid", "inner").select(
        "reporting_date", F.col("campaign_id").alias("camp_id"), "impressions", "clicks", "cost_euro")
    return rollup(facts, ctx, Fallback(fv.CH_DISPLAY), label(cfg, fv.SRC_ADITION))


def adition_partner(cat, cfg, ctx):
    """Partner rows join every valid banner row of their campaign.

    Instead of repeating each fact row once per banner, the banner rows are
    counted per campaign (a dimension aggregate) and the metrics multiplied.
    """
    banners = _valid_idents(cat, cfg).groupBy("campaign_id").agg(F.count(F.lit(1)).cast("int").alias("_n"))
    dat = cat["adition_partner_perf"].filter(F.col("business_date") >= F.lit(cfg.min_date)).filter(
        activity([F.col("impressions"), F.col("budget"), F.col("clicks")], strict=True))
    daily = dat.groupBy(F.col("business_date").alias("reporting_date"), "camp_id").agg(
        F.sum("impressions").alias("impressions"), F.sum("clicks").alias("clicks"), F.sum("budget").alias("cost_euro"))
    j = daily.join(banners, daily["camp_id"] == banners["campaign_id"], "inner")
    n = F.col("_n")
    # a campaign has one count, so these are the day sums already
    sums = j.select(
        "reporting_date", "camp_id", (F.col("impressions") * n).alias("impressions"),
        (F.col("clicks") * n).alias("clicks"), (F.col("cost_euro") * n).alias("cost_euro"))
    return view_rows(sums, ctx, Branch(sums, Fallback(fv.CH_DISPLAY), label(cfg, fv.SRC_ADITION_PARTNER)))


def google_ace(cat, cfg, ctx):
    dat = (cat["google_ads_ad_perf"]
           .filter(F.col("google_account_id") == cfg.google_ace_account)
           .filter(F.col("reporting_date") >= F.lit(cfg.min_date))
           .filter(activity([F.col("impressions"), F.col("costs_in_euro"), F.col("clicks")], strict=True)))
    facts = dat.select("reporting_date", "camp_id", *_metrics(dat, "impressions", "clicks", "costs_in_euro"))
    code, name = fv.PC_GOOGLE_ACE
    return rollup(facts, ctx, Fallback(fv.CH_DISPLAY, code, name), label(cfg, fv.SRC_GOOGLE_ACE))


def gdn(cat, cfg, ctx):
    dat = (cat["google_ad_perf"]
           .filter(F.col("date_col") >= F.lit(cfg.min_date))
           .filter(activity([F.col("impressions"), F.col("cost_euro"), F.col("clicks")], strict=True))
           .filter(F.col("google_account_id") == cfg.gdn_account))
    facts = dat.select(
        F.col("date_col").alias("reporting_date"), "camp_id", "impressions", "clicks", "cost_euro",
        rule_arm(fv.GDN_RULES, F.col("google_campaign_name"), None, cfg).alias("_arm"))
    return rollup(facts, ctx, Fallback(fv.CH_DISPLAY, rules=fv.GDN_RULES), label(cfg, fv.SRC_GOOGLE_AD))


def odin(cat, cfg, ctx):
    dat = (cat["odin_ad_perf"]
           .filter(F.col("reporting_date") >= F.lit(cfg.min_date))
           .filter(activity([F.col("impressions"), F.col("net_revenue_euro")], strict=True))
           .filter(~F.col("odin_customer_id").isin(list(cfg.odin_excluded_customers))))
    facts = dat.select("reporting_date", "camp_id", *_metrics(dat, "impressions", "clicks", "net_revenue_euro"))
    return rollup(facts, ctx, Fallback(fv.CH_DISPLAY), label(cfg, fv.SRC_ODIN), clicks="sum_or_zero")


def adgroup_campaigns(cat, cfg: ReportConfig) -> DataFrame:
    """Campaigns of the account's ad groups: a row per ad group, campaign and run of days."""
    rows = cat["bing_adgroup_perf"].filter(
        F.col("camp_id").isNotNull() & (F.col("bing_account_id") == cfg.bing_audience_account)
        & (F.col("date_col") >= F.lit(cfg.min_date)))
    return day_islands(rows.select("date_col", "bing_adgroup_id", F.col("camp_id").alias("adg_camp_id")),
                       ["bing_adgroup_id", "adg_camp_id"], "date_col")


def bing_audience(cat, cfg, ctx):
    """Campaign id from the ad-group report where one exists on that day.

    Both inputs are fact-sized. The ad-group side becomes intervals of days with the same campaign, a
    fraction of its rows; the performance side is pre-aggregated to (day, ad group, campaign). They
    meet on the ad group with the day inside the interval.
    """
    dat = (cat["bing_ad_perf"]
           .filter(F.col("date_col") >= F.lit(cfg.min_date))
           .filter(activity([F.col("impressions"), F.col("cost_euro"), F.col("clicks")], strict=True))
           .filter(F.col("bing_account_id") == cfg.bing_audience_account)
           .groupBy("date_col", "bing_adgroup_id", "camp_id")
           .agg(F.sum("impressions").alias("impressions"), F.sum("clicks").alias("clicks"),
                F.sum("cost_euro").alias("cost_euro")))
    adg = adgroup_campaigns(cat, cfg).withColumnRenamed("bing_adgroup_id", "_adgroup")
    j = dat.join(adg, (F.col("bing_adgroup_id") == F.col("_adgroup"))
                 & F.col("date_col").between(F.col("first_day"), F.col("last_day")), "left")
    facts = j.select(
        F.col("date_col").alias("reporting_date"),
        F.coalesce(F.col("adg_camp_id"), F.col("camp_id")).alias("camp_id"),
        "impressions", "clicks", "cost_euro")
    return rollup(facts, ctx, Fallback(fv.CH_DISPLAY), label(cfg, fv.SRC_BING_AUDIENCE))


BUILDERS = {
    "dis_adition": adition, "dis_adition_partner": adition_partner, "dis_google_ace": google_ace,
    "dis_gdn": gdn, "dis_odin": odin, "dis_bing_audience": bing_audience,
}


def branch(cat, cfg: ReportConfig, key: str, ctx: DataFrame | None = None) -> DataFrame:
    return BUILDERS[key](cat, cfg, context(cat, cfg) if ctx is None else ctx)


def report(cat, cfg: ReportConfig) -> DataFrame:
    ctx = campaigns_for(cat, distinct=True)
    return channel_view([branch(cat, cfg, k, ctx) for k in KEYS])
