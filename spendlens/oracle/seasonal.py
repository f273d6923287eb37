"""Oracle SQL for the seasonal catalogue cost report, written from its rules.

A catalogue is offered under three order numbers; each is looked up among the costs of its kind.
"""

from __future__ import annotations

from .. import fixed_values as fv
from ..config import ReportConfig
from .common import q, with_

#: Order number of the plan, cost table, and data source of each kind of cost.
KINDS = {
    "cst_creation": ("opp_wbkz", "fx_print_cost", fv.CATALOG_SOURCES[0]),
    "cst_creative": ("ppc_wbkz", "fx_creative_cost", fv.CATALOG_SOURCES[1]),
    "cst_shipping": ("wbkz", "fx_shipping_cost", fv.CATALOG_SOURCES[2]),
}

PROJECT = (f"CASE WHEN regexp_full_match(project_name, {q(fv.CATALOG_PROJECT_MATCH)})"
           f" THEN regexp_replace(project_name, {q(fv.CATALOG_PROJECT_PATTERN)}, '\\1') ELSE project_name END")
SEASON = f"CAST(nullif(regexp_extract(season_year, {q(fv.CATALOG_SEASON_RE)}, 0), '') AS DECIMAL(18,0))"
WEIGHT = (f"(height / 100) * (width / 100) * (content_weight * content_pages + cover_weight * cover_pages) / 2"
          f" * {fv.CATALOG_WEIGHT_FACTOR}"
          f" + CASE shipping_type WHEN {q(fv.CATALOG_PACKAGE)} THEN {fv.CATALOG_PACKAGE_EXTRA} ELSE 0 END")


def shared() -> list[str]:
    """Catalogues with their derived values, all costs with their kind, and the one looked up in the other."""
    numbers = ", ".join(f"{{'data_source': {q(source)}, 'wbkz': {column}}}" for column, _, source in KINDS.values())
    costs = " UNION ALL ".join(f"SELECT {q(source)} AS data_source, auftrag AS wbkz, kostenartenbes AS kostenartenbeschreibung,"
                               f" wert_overall AS costs FROM {table}" for _, table, source in KINDS.values())
    return [
        f"""catalogues AS (SELECT *, {PROJECT} AS project_name_corr, {SEASON} AS season, {WEIGHT} AS katalog_gewicht_gesamt
 FROM fx_print)""",
        f"orders_ AS (SELECT *, unnest([{numbers}]) AS number FROM catalogues)",
        f"all_costs AS ({costs})",
        """offers AS (SELECT o.* EXCLUDE (number, wbkz, shipping_type), lower(o.shipping_type) AS shipping_type,
 o.number.data_source AS data_source, o.number.wbkz AS wbkz, c.kostenartenbeschreibung, CAST(c.costs AS DOUBLE) AS costs
 FROM orders_ o LEFT JOIN all_costs c ON c.data_source = o.number.data_source AND c.wbkz = o.number.wbkz)""",
    ]


def sql(cfg: ReportConfig) -> dict[str, str]:
    head = with_(["fx_print", *(k[1] for k in KINDS.values())], *shared())
    out = {}
    for key, (_, _, source) in KINDS.items():
        out[key] = f"""{head}
SELECT DISTINCT initiative_name, project_name_corr, shipping_type, season, season_year, data_source, wbkz, pages_total,
 circulation_plan, circulation_actual, kostenartenbeschreibung, costs, is_test, katalog_gewicht_gesamt
FROM offers WHERE data_source = {q(source)}"""
    out["report_seasonal_cost"] = f"""{head}
SELECT DISTINCT initiative_name, project_name_corr, shipping_type, season_year, data_source, wbkz,
 ifnull(pages_total, 0) AS pages_total, circulation_plan, circulation_actual,
 ifnull(katalog_gewicht_gesamt, 0) AS katalog_gewicht_gesamt, kostenartenbeschreibung, costs
FROM offers WHERE wbkz IS NOT NULL"""
    out["catalog_project"] = f"{head}\nSELECT DISTINCT project_name, project_name_corr, season_year, season FROM catalogues"
    out["catalog_id"] = f"""{head}
SELECT *, md5(coalesce('v' || project_name_corr, 'n') || '|' || coalesce('v' || CAST(season AS VARCHAR), 'n') || '|'
 || coalesce('v' || shipping_type, 'n')) AS id
FROM (SELECT DISTINCT project_name_corr, season, lower(shipping_type) AS shipping_type FROM catalogues)"""
    out["catalog_weight"] = f"""{head}
SELECT initiative_name, project_name, shipping_type AS pwm_shipping_type, height AS pwm_format_height,
 width AS pwm_format_width, katalog_gewicht_gesamt FROM catalogues"""
    return out
