"""Branding cost view: TV, audio, digital, out-of-home and in-house channels.

Eleven branches, one 13-column schema: budget logic and share, campaign type,
plan flag, campaign id, channel, clicks, media cost, infrastructure cost, total
cost, impressions, day and source.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..config import ReportConfig
from ..functions import budget as B
from ..functions.text import has_upper, lacks
from ..operators.fees import fee_rows, join_fee, month_key
from ..operators.media import booked_days, delivered_days, digital_level3
from ..operators.reconcile import reconcile
from ..operators.rollup import activity
from ..operators.unions import union_all
from .common import label

KEYS = ("bra_tv", "bra_radio", "bra_webradio", "bra_digital", "bra_dooh", "bra_odin",
        "bra_facebook", "bra_pinterest", "bra_snapchat", "bra_youtube", "bra_tiktok")
COLUMNS = ("budget_logic", "budget_logic_share", "campaign_type", "is_plan", "camp_id", "channel", "clicks",
           "media_cost", "infrastructure_cost", "cost_euro", "impressions", "reporting_date", "source_system")


def _finish(df: DataFrame, channel: str | Column, source: str | Column, camp: Column | None = None) -> DataFrame:
    """Totals per (logic, share, type, plan flag, campaign, channel, day) in report types."""
    return df.select(
        F.col("budget_logic").cast("int").alias("budget_logic"),
        F.col("budget_logic_share").cast("double").alias("budget_logic_share"),
        "campaign_type", F.col("is_plan").cast("boolean").alias("is_plan"),
        (camp if camp is not None else F.lit("")).alias("camp_id"),
        (F.lit(channel) if isinstance(channel, str) else channel).alias("channel"),
        F.col("clicks").cast("bigint").alias("clicks"),
        F.col("media_cost").cast("double").alias("media_cost"),
        F.col("infrastructure_cost").cast("double").alias("infrastructure_cost"),
        (F.col("total") if "total" in df.columns else F.col("media_cost") + F.col("infrastructure_cost")).cast("double").alias("cost_euro"),
        F.col("impressions").cast("double").alias("impressions"),
        "reporting_date", (F.lit(source) if isinstance(source, str) else source).alias("source_system"),
    )


# ------------------------------------------------------------ actual vs plan
PLAN_CHANNELS = {"bra_tv": fv.PLAN_TV, "bra_radio": fv.PLAN_RADIO, "bra_webradio": fv.PLAN_WEBRADIO}


def plan_rows(cat, keys=tuple(PLAN_CHANNELS)) -> DataFrame:
    """Plan per branch, day, upper-cased campaign, budget class, type and channel."""
    channel = F.upper(F.col("channel"))
    branch_of = None
    for key in keys:
        hit = channel == PLAN_CHANNELS[key]
        branch_of = F.when(hit, F.lit(key)) if branch_of is None else branch_of.when(hit, F.lit(key))
    p = cat["bpn_planning"].filter(channel.isin([PLAN_CHANNELS[k] for k in keys]))
    return (p.groupBy(branch_of.alias("branch"), F.col("planning_date").alias("p_date"),
                      F.upper(F.col("bpn_campaign_name")).alias("p_name"),
                      B.logic_from_origin(F.col("budget_origin")).alias("p_logic"),
                      B.type_from_origin(F.col("budget_origin")).alias("p_type"), F.col("channel"))
            .agg(F.sum("cost_euro_nnn_planned").alias("p_cost"), F.sum("gross_contacts_planned").alias("p_volume"))
            .drop("channel"))


def tv_actuals(cat) -> DataFrame:
    t = cat["tv_flights"]
    name = F.upper(F.col("tv_flight_name"))
    return (t.groupBy(F.col("broadcast_date").alias("a_date"), name.alias("a_name"))
            .agg(F.sum("cost_euro_nnn").alias("a_cost"),
                 F.sum(F.col("viewers_millions_e18p") * 1000000).alias("a_volume"))
            .withColumn("a_logic", B.logic_from_name(F.col("a_name")))
            .withColumn("a_type", B.type_from_name(F.col("a_name"))))


def radio_actuals(cat, source: str, date_col: str, volume_col: str, same_day: bool) -> DataFrame:
    """Radio actuals: classes from the raw name (no upper-casing), grouped by raw name too."""
    r = cat[source]
    if same_day:
        r = r.filter(F.col("reporting_start_date") == F.col("reporting_end_date"))
    raw = F.col("bpn_radio_campaign_name")
    return (r.groupBy(F.col(date_col).alias("a_date"), F.upper(raw).alias("a_name"),
                      B.logic_from_name(raw).alias("a_logic"), B.type_from_name(raw).alias("a_type"),
                      raw.alias("_raw"))
            .agg(F.sum("cost_euro_nnn").alias("a_cost"), F.sum(volume_col).alias("a_volume"))
            .drop("_raw"))


BROADCAST = {
    "bra_tv": (tv_actuals, fv.CH_TV, fv.SRC_TV),
    "bra_radio": (lambda cat: radio_actuals(cat, "radio_marketer", "reporting_start_date", "contacts", same_day=True),
                  fv.CH_AUDIO, fv.SRC_RADIO),
    "bra_webradio": (lambda cat: radio_actuals(cat, "radio_webradio", "reporting_date", "impressions", same_day=False),
                     fv.CH_AUDIO, fv.SRC_WEBRADIO),
}


def _by_key(key: Column, values: dict) -> Column:
    """The value of each branch key."""
    out = None
    for k, v in values.items():
        out = F.when(key == k, F.lit(v)) if out is None else out.when(key == k, F.lit(v))
    return out


def broadcast_media(cat, cfg: ReportConfig, keys=tuple(BROADCAST)) -> DataFrame:
    """TV, radio and webradio: actual against plan with the month's fee, in one join each.

    The branches share the plan and fee tables, so these are read once, with the branch as a key."""
    actual = union_all([BROADCAST[k][0](cat).withColumn("branch", F.lit(k)) for k in keys])
    rows = reconcile(actual, plan_rows(cat, keys), cfg.branding_min_date, cfg.yesterday, by=("branch",))
    named = F.col("channel_branding")
    applies = F.when(named == fv.FEE_TV, F.array(F.lit("bra_tv"))).when(
        F.upper(named) == fv.FEE_FUNK, F.array(F.lit("bra_radio"), F.lit("bra_webradio")))
    fees = cat["agency_fee"].filter((named == fv.FEE_TV) | (F.upper(named) == fv.FEE_FUNK)).select(
        F.explode(applies).alias("branch"), F.col("year_month").cast("decimal(6,0)").cast("int").alias("_month"), "fee")
    j = rows.withColumn("_month", month_key(F.col("reporting_date"))).join(fees, ["branch", "_month"], "left")
    g = (j.groupBy("branch", "budget_logic", "campaign_type", "is_plan", "reporting_date")
         .agg(F.sum("media_cost").alias("media_cost"),
              F.sum(F.col("infra_base") * F.col("fee")).alias("infrastructure_cost"),
              F.sum("impressions").alias("impressions"))
         .withColumn("budget_logic_share", B.share_from_class(F.col("budget_logic")))
         .withColumn("clicks", F.lit(0)))
    key = F.col("branch")
    return _finish(g, _by_key(key, {k: BROADCAST[k][1] for k in keys}),
                   _by_key(key, {k: label(cfg, BROADCAST[k][2]) for k in keys}))


# ------------------------------------------------------------------- digital
def digital_sums(cat, cfg: ReportConfig) -> DataFrame:
    """Both legs with the month's fee, per (day, scope, id group, channel)."""
    # a month and media type with several fee rows repeats its rows; the largest fee counts
    fees = (fee_rows(cat["agency_fee"], fv.FEE_DIGITAL, True)
            .groupBy("fee_month", F.upper("sub_channel_branding").alias("sub_channel_branding")).agg(F.max("fee").alias("fee"), F.count(F.lit(1)).alias("_fees")))
    return digital_level3(cat["bpn_adition_perf"], cat["adgap_id_mapping"], cat["digital_mediaplan"], fees,
                          cfg.branding_min_date, cfg.yesterday)


def digital(cat, cfg):
    """Booked and delivered legs, fee by month and media type, effective cost capped at booked.

    The reference aggregates five times; three of the levels repeat the keys of
    the level below (one row per group), so they are projections here.
    """
    lvl3 = digital_sums(cat, cfg)
    media = F.when(F.col("kosten_nnn_eff") > F.col("kosten_nnn"), F.col("kosten_nnn")).otherwise(F.col("kosten_nnn_eff"))
    lvl1 = lvl3.select("datum", "campaign_scope", "channel", "clicks", "impressions",
                       media.alias("media_cost"), (media * F.col("fee")).alias("infrastructure_cost"))
    scope = F.col("campaign_scope")
    keyed = (lvl1.withColumn("budget_logic", F.when(scope == fv.SCOPE_WKZ, 3).otherwise(1))
             .withColumn("campaign_type", F.when(scope == fv.SCOPE_VERTRIEB, F.lit(fv.TYPE_VERTRIEB))
                         .otherwise(F.lit(fv.TYPE_BRANDING))))
    g = (keyed.groupBy("budget_logic", "campaign_type", "channel", F.col("datum").alias("reporting_date"))
         .agg(F.sum("clicks").alias("clicks"), F.sum("media_cost").alias("media_cost"),
              F.sum("infrastructure_cost").alias("infrastructure_cost"), F.sum("impressions").alias("impressions"))
         .withColumn("budget_logic_share", B.share_from_class(F.col("budget_logic")))
         .withColumn("is_plan", F.lit(False)))
    return _finish(g, F.col("channel"), label(cfg, fv.SRC_DIGITAL))


# -------------------------------------------------------------- out of home
def dooh(cat, cfg):
    src = cat.days("dooh_perf", dt.date(cfg.dooh_min_year, 1, 1), cfg.yesterday).filter(~F.upper(F.col("cost_type")).isin(list(fv.DOOH_EXCLUDED_COST_TYPES)))
    sub = F.when(has_upper(F.col("cost_type"), fv.DOOH_PROGRAMMATIC_MARK), F.lit(fv.DOOH_PROGRAMMATIC)) \
        .otherwise(F.lit(fv.DOOH_PLAIN))
    jvb = (src.groupBy(F.col("planning_date").cast("date").alias("reporting_date"), sub.alias("sub_channel"),
                       F.col("jostvonbrandis_campaign_name").alias("campaign_name"))
           .agg(F.sum("cost_euro_nn_without_bonus").alias("nn"), F.sum("cost_euro_nnn").alias("nnn"))
           # EXTRACT(YEAR ..) >= y written as a date range
           .filter(F.col("reporting_date") >= F.lit(dt.date(cfg.dooh_min_year, 1, 1)))
           .filter(F.col("reporting_date") <= F.lit(cfg.yesterday)))
    fees = fee_rows(cat["agency_fee"], fv.FEE_DOOH, True)
    j = join_fee(jvb, "reporting_date", fees, sub_channel=F.upper(F.col("sub_channel")),
                 cols=("fee", "discount", "managed_fee", "dsp_fee"))
    u = F.upper(F.col("sub_channel"))
    nn, nnn = F.col("nn"), F.col("nnn")
    media = nn - nn * F.col("discount")  # both sub channels
    infra = F.when(u == fv.DOOH_PROGRAMMATIC,
                   nnn * F.col("managed_fee") + nnn * F.col("dsp_fee") + nnn * F.col("fee")) \
        .when(u == fv.DOOH_PLAIN, nnn * F.col("fee"))
    name = F.upper(F.col("campaign_name"))
    keyed = (j.withColumn("budget_logic", B.logic_from_name(name))
             .withColumn("campaign_type", B.type_from_name(name, fv.NAME_VERTRIEB_DOOH)))
    g = (keyed.groupBy("budget_logic", "campaign_type", "reporting_date")
         .agg(F.sum(media).alias("media_cost"), F.sum(infra).alias("infrastructure_cost"))
         .withColumn("budget_logic_share", B.share_from_class(F.col("budget_logic")))
         .withColumn("is_plan", F.lit(False)).withColumn("clicks", F.lit(0)).withColumn("impressions", F.lit(0)))
    return _finish(g, fv.CH_DOOH, label(cfg, fv.SRC_DOOH))


# ------------------------------------------------------------------ in-house
def _campaign_multiplier(cat) -> DataFrame:
    """Rows per campaign id in the campaign table.

    The in-house branches LEFT JOIN the campaign table without using its
    columns, which only repeats rows for duplicated ids. Counting the rows per
    id (a dimension aggregate) and multiplying the sums gives the same result
    without joining the fact row by row.
    """
    return (cat["campaign_persist"].filter(F.col("campaign_id").isNotNull())
         .groupBy(F.col("campaign_id").alias("camp_id")).agg(F.count(F.lit(1)).cast("int").alias("_n")))


INHOUSE = {  # channel, source, tool fee, class of a campaign id
    "bra_odin": (fv.CH_DISPLAY_BRANDING, fv.SRC_ODIN, False, B.budget_logic_reduced),
    "bra_facebook": (fv.CH_SOCIAL_BRANDING, fv.SRC_FACEBOOK, True, B.budget_logic),
    "bra_pinterest": (fv.CH_SOCIAL_BRANDING, fv.SRC_PINTEREST, False, B.budget_logic),
    "bra_snapchat": (fv.CH_SOCIAL_BRANDING, fv.SRC_SNAPCHAT, True, B.budget_logic),
    "bra_youtube": (fv.CH_ONLINE_VIDEO, fv.SRC_GOOGLE_AD, False, B.budget_logic),
    "bra_tiktok": (fv.CH_SOCIAL_BRANDING, fv.SRC_TIKTOK, False, B.budget_logic),
}


def inhouse(cat, cfg: ReportConfig, keys=tuple(INHOUSE)) -> DataFrame:
    """In-house display and social: sums per (day, campaign), scaled by the campaign table's row counts.

    Facts are summed per branch, brought together and joined with the counts once. Sums are
    exact (BIGINT, DECIMAL) up to the one division by the exchange rate.
    """
    sums = union_all([
        FACTS[k](cat, cfg).groupBy("reporting_date", "camp_id").agg(
            F.sum("impressions").alias("impressions"), F.sum("clicks").alias("clicks"), F.sum("cost").alias("media_cost"))
        .withColumn("branch", F.lit(k)) for k in keys])
    key, odin = F.col("branch"), F.col("branch") == "bra_odin"
    g = sums.join(_campaign_multiplier(cat), "camp_id", "left")
    n = F.coalesce(F.col("_n"), F.lit(1))
    spend = F.col("media_cost")
    with_tool = _by_key(key, {k: INHOUSE[k][2] for k in keys})
    tool = spend * F.lit(fv.TOOL_FEE).cast("decimal(4,3)") * n
    infra = F.when(with_tool, tool).cast("double")
    exact = spend * n + tool  # money stays DECIMAL up to the cast
    if "bra_odin" in keys:
        # days with several rates repeat their rows; the largest rate counts
        rates = cat["exchange_rates"].groupBy("reporting_date").agg(
            F.max("exchange_rate_eur_to_usd").alias("_rate"), F.count(F.lit(1)).cast("int").alias("_rates"))
        g = g.join(rates, "reporting_date", "left")
        n = n * F.when(odin, F.coalesce(F.col("_rates"), F.lit(1))).otherwise(F.lit(1))
        usd = F.col("impressions") * F.lit(str(Decimal(fv.ODIN_USD_PER_MILLE) / 1000)).cast("decimal(7,6)") * n
        fee = (spend * F.lit(fv.ODIN_SPEND_FEE).cast("decimal(3,2)") * n).cast("double") \
            + usd.cast("double") / F.col("_rate").cast("double")
        infra = F.when(odin, fee).otherwise(infra)
    plain = ~_by_key(key, {k: INHOUSE[k][2] or k == "bra_odin" for k in keys})
    camp = F.col("camp_id")
    logic = None
    for k in keys:
        value = INHOUSE[k][3](camp)
        logic = F.when(key == k, value) if logic is None else logic.when(key == k, value)
    out = g.select(
        "branch", "reporting_date", "camp_id", (F.col("impressions") * n).alias("impressions"),
        F.when(odin, F.lit(0)).otherwise(F.col("clicks") * n).alias("clicks"), (spend * n).alias("media_cost"),
        F.when(plain, F.lit(0.0)).otherwise(infra).alias("infrastructure_cost"), logic.alias("budget_logic"),
        F.when(with_tool, exact.cast("double")).when(plain, (spend * n).cast("double"))
        .otherwise((spend * n).cast("double") + infra).alias("total"),
    ).withColumn("budget_logic_share", B.budget_share_ws(camp, F.col("budget_logic"))) \
        .withColumn("campaign_type", F.lit(fv.TYPE_BRANDING)).withColumn("is_plan", F.lit(False))
    return _finish(out, _by_key(key, {k: INHOUSE[k][0] for k in keys}),
                   _by_key(key, {k: label(cfg, INHOUSE[k][1]) for k in keys}), camp=camp)


def odin(cat, cfg):
    dat = (cat["odin_ad_perf"]
           .filter(F.col("reporting_date") >= F.lit(cfg.branding_min_date))
           .filter(activity([F.col("impressions"), F.col("net_revenue_euro")], strict=False))
           .filter(F.col("odin_customer_id") == cfg.odin_branding_customer))
    return dat.select("reporting_date", "camp_id", "impressions", "clicks", F.col("net_revenue_euro").alias("cost"))


def _social_excluded(camp: str, name: str) -> Column:
    """Not both markers of a social performance campaign (OR of negations, as written)."""
    return lacks(F.col(camp), fv.SOCIAL_MARK) | (F.instr(F.upper(F.col(name)), fv.PERFORMANCE) == 0)


def facebook(cat, cfg):
    dat = (cat["facebook_ad_perf"]
           .filter(F.col("reporting_date") >= F.lit(cfg.branding_min_date))
           .filter(F.col("facebook_account_id") == cfg.facebook_branding_account)
           .filter(activity([F.col("impressions"), F.col("cost_euro"), F.col("clicks")], strict=False)))
    return dat.select("reporting_date", "camp_id", "impressions", "clicks", F.col("cost_euro").alias("cost"))


def pinterest(cat, cfg):
    dat = (cat["pinterest_pin_perf"]
           .filter(F.col("reporting_date") >= F.lit(cfg.branding_min_date))
           .filter(activity([F.col("impressions_paid"), F.col("cost_euro"), F.col("clicks_paid")], strict=False))
           .filter(_social_excluded("camp_id", "pinterest_campaign_name")))
    return dat.select("reporting_date", "camp_id", F.col("impressions_paid").alias("impressions"),
                       F.col("clicks_paid").alias("clicks"), F.col("cost_euro").alias("cost"))


def snapchat(cat, cfg):
    dat = (cat["snap_ad_perf"]
           .filter(F.col("reporting_date") >= F.lit(cfg.branding_min_date))
           .filter(F.lower(F.col("snap_account_name")) == cfg.snap_branding_account_name)
           .filter(activity([F.col("impressions"), F.col("cost_euro")], strict=False)))
    return dat.select("reporting_date", "camp_id", "impressions", F.lit(0).cast("bigint").alias("clicks"),
                       F.col("cost_euro").alias("cost"))


def youtube(cat, cfg):
    dat = (cat["google_ad_perf"]
           .filter(F.col("date_col") >= F.lit(cfg.branding_min_date))
           .filter(activity([F.col("impressions"), F.col("cost_euro"), F.col("clicks")], strict=False))
           .filter(F.col("google_account_id").isin(list(cfg.youtube_branding_accounts)))
           .filter(_social_excluded("camp_id", "google_campaign_name")))
    return dat.select(F.col("date_col").alias("reporting_date"), "camp_id", "impressions", "clicks",
                       F.col("cost_euro").alias("cost"))


def tiktok(cat, cfg):
    dat = (cat["tiktok_ad_perf"]
           .filter(F.col("reporting_date") >= F.lit(cfg.branding_min_date))
           .filter(F.col("tiktok_account_id") == cfg.tiktok_branding_account)
           .filter(activity([F.col("impressions"), F.col("cost_euro"), F.col("clicks")], strict=False))
           .filter(_social_excluded("camp_id", "tiktok_campaign_name")))
    return dat.select("reporting_date", "camp_id", "impressions", "clicks", F.col("cost_euro").alias("cost"))


FACTS = {"bra_odin": odin, "bra_facebook": facebook, "bra_pinterest": pinterest, "bra_snapchat": snapchat,
         "bra_youtube": youtube, "bra_tiktok": tiktok}


def branch(cat, cfg: ReportConfig, key: str) -> DataFrame:
    if key in BROADCAST:
        return broadcast_media(cat, cfg, (key,)).select(*COLUMNS)
    if key in INHOUSE:
        return inhouse(cat, cfg, (key,)).select(*COLUMNS)
    return {"bra_digital": digital, "bra_dooh": dooh}[key](cat, cfg).select(*COLUMNS)


def report(cat, cfg: ReportConfig) -> DataFrame:
    parts = (broadcast_media(cat, cfg), digital(cat, cfg), dooh(cat, cfg), inhouse(cat, cfg))
    return union_all([p.select(*COLUMNS) for p in parts])


def booked_leg(cat, cfg: ReportConfig) -> DataFrame:
    """Booked days up to the run's day; the report's own cut at yesterday comes later."""
    return booked_days(cat["digital_mediaplan"], cfg.branding_min_date, cfg.as_of)


def delivered_leg(cat, cfg: ReportConfig) -> DataFrame:
    return delivered_days(cat["bpn_adition_perf"], cat["adgap_id_mapping"], cat["digital_mediaplan"],
                          cfg.branding_min_date, cfg.yesterday)
