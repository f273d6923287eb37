"""Oracle SQL for the search-ads view."""

from __future__ import annotations

from .. import fixed_values as fv
from ..config import ReportConfig
from .common import branch_only_sql, channel_branch_sql, context_ctes, d, view_sql, with_

BRANCHES = {
    "sea_google_keyword": ("fx_perf", fv.PC_GOOGLE_KEYWORD, fv.SRC_GOOGLE_KEYWORD, False),
    "sea_google_dsa": ("fx_dsa", fv.PC_GOOGLE_DSA, fv.SRC_GOOGLE_DSA, False),
    "sea_bing_keyword": ("fx_bing", fv.PC_BING_KEYWORD, fv.SRC_BING_KEYWORD, False),
    "sea_bing_keyword_legacy": ("fx_bing_legacy", fv.PC_BING_KEYWORD, fv.SRC_BING_KEYWORD, True),
    "sea_bing_dsa": ("fx_bing_dsa", fv.PC_BING_DSA, fv.SRC_BING_DSA, False),
}


def _branch(cfg: ReportConfig, key: str) -> str:
    table, (code, name), suffix, legacy = BRANCHES[key]
    date_cond = (f"dat.reporting_date BETWEEN {d(cfg.legacy_from)} AND {d(cfg.legacy_to)}" if legacy
                 else f"dat.reporting_date >= {d(cfg.min_date)}")
    return channel_branch_sql(
        table=f"{table} AS dat", date="dat.reporting_date", camp="dat.camp_id",
        metrics={"impressions": "sum(dat.impressions)", "clicks": "sum(dat.clicks)", "cost_euro": "sum(dat.cost_euro)"},
        where=f"(coalesce(dat.impressions, 0) + coalesce(dat.cost_euro, 0) + coalesce(dat.clicks, 0)) > 0 AND {date_cond}",
        channel=fv.CH_SEA, code=code, name=name, label=f"{cfg.env}_{suffix}",
    )


def sql(cfg: ReportConfig) -> dict[str, str]:
    head = with_([*(b[0] for b in BRANCHES.values()), "fx_map"], *context_ctes(distinct=False))
    out = {k: branch_only_sql(head, _branch(cfg, k)) for k in BRANCHES}
    union = "\nUNION ALL\n".join(_branch(cfg, k) for k in BRANCHES)
    out["report_sea"] = view_sql(head, union, "instr(camp_id, 'B.AC') = 0")
    return out
