"""Search-ads cost view: five keyword/DSA sources, one row per day and campaign."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..config import ReportConfig
from ..functions.text import lacks
from ..operators.context import Fallback
from ..operators.rollup import Branch, activity, day_sums, view_rows
from .common import campaigns_for, channel_view, context_for, label

# key -> (source, planning-context fallback, lineage label, legacy date range)
BRANCHES = {
    "sea_google_keyword": ("google_keyword_perf", fv.PC_GOOGLE_KEYWORD, fv.SRC_GOOGLE_KEYWORD, False),
    "sea_google_dsa": ("google_dsa_perf", fv.PC_GOOGLE_DSA, fv.SRC_GOOGLE_DSA, False),
    "sea_bing_keyword": ("bing_keyword_perf", fv.PC_BING_KEYWORD, fv.SRC_BING_KEYWORD, False),
    "sea_bing_keyword_legacy": ("bing_keyword_perf_legacy", fv.PC_BING_KEYWORD, fv.SRC_BING_KEYWORD, True),
    "sea_bing_dsa": ("bing_dsa_perf", fv.PC_BING_DSA, fv.SRC_BING_DSA, False),
}


def context(cat, cfg: ReportConfig) -> DataFrame:
    return context_for(cat, cfg, distinct=False)


def facts(cat, cfg: ReportConfig, key: str) -> Branch:
    """A branch's standardized facts and what becomes of their sums."""
    source, (code, name), suffix, legacy = BRANCHES[key]
    d = F.col("date_col")
    in_range = d.between(F.lit(cfg.legacy_from), F.lit(cfg.legacy_to)) if legacy else d >= F.lit(cfg.min_date)
    rows = (
        cat[source]
        .filter(in_range)
        .filter(activity([F.col("impressions"), F.col("cost_euro"), F.col("clicks")], strict=True))
        .select(d.alias("reporting_date"), "camp_id", "impressions", "clicks", "cost_euro")
    )
    return Branch(rows, Fallback(fv.CH_SEA, code, name), label(cfg, suffix))


def branch(cat, cfg: ReportConfig, key: str, ctx: DataFrame | None = None) -> DataFrame:
    b = facts(cat, cfg, key)
    return view_rows(day_sums(b), context(cat, cfg) if ctx is None else ctx, b)


def view(branches: list[DataFrame]) -> DataFrame:
    """The report of its branches' rows: NULL camp_id is dropped here (INSTR of NULL is NULL)."""
    return channel_view(branches).filter(lacks(F.col("camp_id"), fv.SEA_EXCLUDE_MARK))


def report(cat, cfg: ReportConfig) -> DataFrame:
    ctx = campaigns_for(cat, distinct=False)
    return view([branch(cat, cfg, k, ctx) for k in BRANCHES])
