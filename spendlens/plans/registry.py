"""Query registry: one entry per operator, branch and report."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..config import ReportConfig, testing
from ..operators.rollup import money_to_double
from ..sources.catalog import fixture_catalog
from . import affiliate, branding, display, search, seasonal, social, units

Builder = Callable[[object, ReportConfig], DataFrame]


def builders() -> dict[str, Builder]:
    out: dict[str, Builder] = {}
    for key in search.BRANCHES:
        out[key] = lambda cat, cfg, k=key: money_to_double(search.branch(cat, cfg, k))
    out["report_sea"] = search.report
    for mod, rep in ((display, "report_display"), (social, "report_social")):
        for key in mod.KEYS:
            out[key] = lambda cat, cfg, k=key, m=mod: money_to_double(m.branch(cat, cfg, k))
        out[rep] = mod.report
    for key in affiliate.KEYS:
        out[key] = lambda cat, cfg, k=key: money_to_double(affiliate.branch(cat, cfg, k))
    out["report_affiliate"] = affiliate.report
    for key in seasonal.KEYS:
        out[key] = lambda cat, cfg, k=key: seasonal.branch(cat, cfg, k)
    out["report_seasonal_cost"] = seasonal.report
    out["catalog_project"] = seasonal.project
    out["catalog_weight"] = seasonal.weight
    out["catalog_id"] = seasonal.ids
    for key in branding.KEYS:
        out[key] = lambda cat, cfg, k=key: branding.branch(cat, cfg, k)
    out["report_branding"] = branding.report
    out["bra_digital_booked"] = branding.booked_leg
    out["bra_digital_delivered"] = branding.delivered_leg
    out.update(units.BUILDERS)
    return out


def queries(cfg: ReportConfig | None = None) -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    cfg = cfg or testing()

    def bind(b: Builder):
        return lambda spark, sf_dir: b(fixture_catalog(spark, sf_dir), cfg)

    return {k: bind(b) for k, b in builders().items()}


def oracle_sql(cfg: ReportConfig | None = None) -> dict[str, str]:
    from ..oracle import affiliate as o_affiliate
    from ..oracle import branding as o_branding
    from ..oracle import channels as o_channels
    from ..oracle import seasonal as o_seasonal
    from ..oracle import units as o_units
    from ..oracle import search as o_search

    cfg = cfg or testing()
    out: dict[str, str] = {}
    out.update(o_search.sql(cfg))
    out.update(o_channels.sql(cfg))
    out.update(o_affiliate.sql(cfg))
    out.update(o_seasonal.sql(cfg))
    out.update(o_branding.sql(cfg))
    out.update(o_units.sql(cfg))
    return out
