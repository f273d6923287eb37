"""Oracle SQL for the display and social views."""

from __future__ import annotations

import datetime as dt

from .. import fixed_values as fv
from ..config import ReportConfig
from .common import branch_only_sql, channel_branch_sql, context_ctes, d, view_sql, with_

STD3 = {"impressions": "sum(dat.impressions)", "clicks": "sum(dat.clicks)", "cost_euro": "sum(dat.cost_euro)"}


def _loose(*cols):
    return "(" + " + ".join(f"coalesce(dat.{c}, 0)" for c in cols) + ") != 0"


def _strict(*cols):
    return "(" + " + ".join(f"coalesce(dat.{c}, 0)" for c in cols) + ") > 0"


def display_branches(cfg: ReportConfig) -> dict[str, str]:
    until = f"TIMESTAMP '{(cfg.as_of + dt.timedelta(days=1)).isoformat()} 00:00:00'"
    lab = lambda s: f"{cfg.env}_{s}"
    floor = d(cfg.min_date)
    out = {}
    out["dis_adition"] = channel_branch_sql(
        table="fx_banner AS dat", joins=f"LEFT JOIN fx_ident AS std ON dat.bid = std.bid AND std.banner_known_until_utc > {until}",
        date="dat.reporting_date", camp="std.campaign_id", metrics=STD3, ctx_on="std.campaign_id = pc.camp_id",
        where=f"dat.reporting_date >= {floor} AND {_loose('impressions', 'cost_euro', 'clicks')} AND std.campaign_id != '-1'",
        channel=fv.CH_DISPLAY, label=lab(fv.SRC_ADITION))
    out["dis_adition_partner"] = channel_branch_sql(
        table="fx_partner AS dat",
        joins=f"LEFT JOIN fx_ident AS std ON dat.camp_id = std.campaign_id AND std.banner_known_until_utc > {until}",
        date="dat.reporting_date", camp="std.campaign_id", metrics=STD3, ctx_on="std.campaign_id = pc.camp_id",
        where=f"dat.reporting_date >= {floor} AND {_strict('impressions', 'cost_euro', 'clicks')} AND std.campaign_id != '-1'",
        channel=fv.CH_DISPLAY, label=lab(fv.SRC_ADITION_PARTNER))
    code, name = fv.PC_GOOGLE_ACE
    out["dis_google_ace"] = channel_branch_sql(
        table="fx_ace AS dat", date="dat.reporting_date", camp="dat.camp_id", metrics=STD3,
        where=f"dat.account_id = {cfg.google_ace_account} AND dat.reporting_date >= {floor} AND {_strict('impressions', 'cost_euro', 'clicks')}",
        channel=fv.CH_DISPLAY, code=code, name=name, label=lab(fv.SRC_GOOGLE_ACE))
    out["dis_gdn"] = channel_branch_sql(
        table="fx_gads AS dat", date="dat.reporting_date", camp="dat.camp_id", metrics=STD3,
        where=f"dat.reporting_date >= {floor} AND {_strict('impressions', 'cost_euro', 'clicks')} AND dat.account_id = {cfg.gdn_account}",
        channel=fv.CH_DISPLAY, rules=fv.GDN_RULES, rule_name="dat.campaign_name", cfg=cfg, label=lab(fv.SRC_GOOGLE_AD))
    excl = ", ".join(str(x) for x in cfg.odin_excluded_customers)
    out["dis_odin"] = channel_branch_sql(
        table="fx_odin AS dat", date="dat.reporting_date", camp="dat.camp_id",
        metrics={"impressions": "sum(dat.impressions)", "clicks": "coalesce(sum(dat.clicks), 0)", "cost_euro": "sum(dat.cost_euro)"},
        where=f"dat.reporting_date >= {floor} AND {_strict('impressions', 'cost_euro')} AND dat.customer_id NOT IN ({excl})",
        channel=fv.CH_DISPLAY, label=lab(fv.SRC_ODIN))
    acct = cfg.bing_audience_account
    out["dis_bing_audience"] = channel_branch_sql(
        table="fx_bing_ads AS dat",
        joins=("LEFT JOIN (SELECT DISTINCT date_col, account_id, adgroup_id, camp_id FROM fx_adgroup"
               f" WHERE camp_id IS NOT NULL AND account_id = {acct}) AS adg"
               " ON dat.adgroup_id = adg.adgroup_id AND dat.reporting_date = adg.date_col AND dat.account_id = adg.account_id"),
        date="dat.reporting_date", camp="coalesce(adg.camp_id, dat.camp_id)", metrics=STD3,
        ctx_on="pc.camp_id = coalesce(adg.camp_id, dat.camp_id)",
        where=f"dat.reporting_date >= {floor} AND {_strict('impressions', 'cost_euro', 'clicks')} AND dat.account_id = {acct}",
        channel=fv.CH_DISPLAY, label=lab(fv.SRC_BING_AUDIENCE))
    return out


def social_branches(cfg: ReportConfig) -> dict[str, str]:
    lab = lambda s: f"{cfg.env}_{s}"
    floor = d(cfg.min_date)
    marked = "(instr(dat.camp_id, '-SA.C-') > 0 OR instr(upper(dat.campaign_name), 'PERFORMANCE') > 0)"
    out = {}
    excl = ", ".join(str(x) for x in cfg.facebook_excluded_accounts)
    out["soc_facebook"] = channel_branch_sql(
        table="fx_facebook AS dat", date="dat.reporting_date", camp="dat.camp_id", metrics=STD3,
        where=f"dat.reporting_date >= {floor} AND {marked} AND {_strict('impressions', 'cost_euro', 'clicks')} AND dat.account_id NOT IN ({excl})",
        channel=fv.CH_SOCIAL, rules=fv.FACEBOOK_RULES, rule_name="dat.campaign_name", cfg=cfg, label=lab(fv.SRC_FACEBOOK))
    out["soc_pinterest"] = channel_branch_sql(
        table="fx_pinterest AS dat", date="dat.reporting_date", camp="dat.camp_id", metrics=STD3,
        where=f"dat.reporting_date >= {floor} AND {_strict('impressions', 'cost_euro', 'clicks')} AND {marked}",
        channel=fv.CH_SOCIAL, rules=fv.PINTEREST_RULES, rule_name="dat.campaign_name", cfg=cfg, label=lab(fv.SRC_PINTEREST))
    out["soc_snapchat"] = channel_branch_sql(
        table="fx_snap AS dat", date="dat.reporting_date", camp="dat.camp_id",
        metrics={"impressions": "sum(dat.impressions)", "clicks": "0", "cost_euro": "sum(dat.cost_euro)"},
        where=f"dat.reporting_date >= {floor} AND {_strict('impressions', 'cost_euro')} AND {marked}",
        channel=fv.CH_SOCIAL, rules=fv.SNAPCHAT_RULES, rule_name="dat.campaign_name", cfg=cfg, label=lab(fv.SRC_SNAPCHAT))
    yt = ", ".join(str(x) for x in cfg.youtube_accounts)
    code, name = fv.PC_YOUTUBE
    out["soc_youtube"] = channel_branch_sql(
        table="fx_gads AS dat", date="dat.reporting_date", camp="dat.camp_id", metrics=STD3,
        where=(f"dat.reporting_date >= {floor} AND {_strict('impressions', 'cost_euro', 'clicks')} AND dat.account_id IN ({yt})"
               " AND (instr(dat.camp_id, '-SA.C-') > 0 OR instr(upper(dat.campaign_name), 'PERFORMANCE') > 0"
               " OR instr(upper(dat.campaign_name), 'WKZ') > 0)"),
        channel=fv.CH_SOCIAL, code=code, name=name, label=lab(fv.SRC_GOOGLE_AD))
    out["soc_tiktok"] = channel_branch_sql(
        table="fx_tiktok AS dat", date="dat.reporting_date", camp="dat.camp_id", metrics=STD3,
        where=f"dat.reporting_date >= {floor} AND {_strict('impressions', 'cost_euro', 'clicks')} AND {marked}",
        channel=fv.CH_SOCIAL, rules=fv.TIKTOK_RULES, rule_name="dat.campaign_name", rule_account="dat.account_id",
        cfg=cfg, label=lab(fv.SRC_TIKTOK))
    return out


def sql(cfg: ReportConfig) -> dict[str, str]:
    out = {}
    head = with_(["fx_banner", "fx_partner", "fx_ace", "fx_gads", "fx_odin", "fx_bing_ads", "fx_map", "fx_ident", "fx_adgroup"], *context_ctes(distinct=True))
    dis = display_branches(cfg)
    out.update({k: branch_only_sql(head, v) for k, v in dis.items()})
    out["report_display"] = view_sql(head, "\nUNION ALL\n".join(dis.values()))
    head = with_(["fx_facebook", "fx_pinterest", "fx_snap", "fx_gads", "fx_tiktok", "fx_map"], *context_ctes(distinct=False))
    soc = social_branches(cfg)
    out.update({k: branch_only_sql(head, v) for k, v in soc.items()})
    out["report_social"] = view_sql(head, "\nUNION ALL\n".join(soc.values()),
                                    "instr(camp_id, 'B.AC-') = 0 OR camp_id IS NULL")
    return out
