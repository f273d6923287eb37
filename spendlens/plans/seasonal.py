"""Seasonal catalogue cost comparison.

Three branches join the catalogue plan to a cost table on an order number
(creation, creative, shipping), derive project, season and weight, and are
combined into one deduplicated 12-column report.

Rewrite: the reference joins every plan row to every cost row of its order number
and deduplicates the result, branch by branch and again over the union. Order
numbers are few, so that join grows with plan rows times cost rows. Here the plan
(in the columns that are put out) and the costs are deduplicated before they meet:
pairs of distinct rows are distinct, a plan row without costs stands once, and the
branches differ in their data source. Nothing is deduplicated after a join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..config import ReportConfig
from ..functions.catalog import catalog_id, catalog_weight, project_name_corr, season
from ..operators.unions import union_all

KEYS = ("cst_creation", "cst_creative", "cst_shipping")
# key -> (cost table, order-number column of the plan, data source label)
BRANCHES = {
    "cst_creation": ("print_creation_cost", "pwm_opp_wbkz", fv.CATALOG_SOURCES[0]),
    "cst_creative": ("print_creative_cost", "pwm_ppc_wbkz", fv.CATALOG_SOURCES[1]),
    "cst_shipping": ("print_shipping_cost", "pwm_wbkz", fv.CATALOG_SOURCES[2]),
}
REPORT_COLUMNS = (
    "initiative_name", "project_name_corr", "shipping_type", "season_year", "data_source", "wbkz",
    "pages_total", "circulation_plan", "circulation_actual", "katalog_gewicht_gesamt",
    "kostenartenbeschreibung", "costs",
)
BRANCH_COLUMNS = (
    "initiative_name", "project_name_corr", "shipping_type", "season", "season_year", "data_source", "wbkz",
    "pages_total", "circulation_plan", "circulation_actual", "kostenartenbeschreibung", "costs", "is_test",
    "katalog_gewicht_gesamt",
)


def derived(plan: DataFrame) -> DataFrame:
    """Project clean-up, lower-cased shipping type, season and weight per plan row."""
    p = F.col
    return plan.select(
        "*",
        project_name_corr(p("project_name")).alias("project_name_corr"),
        F.lower(p("pwm_shipping_type")).alias("shipping_type"),
        season(p("pwm_season_financial_year")).alias("season"),
        catalog_weight(p("pwm_shipping_type"), p("pwm_format_height"), p("pwm_format_width"),
                       p("pwm_content_surface_weight"), p("pwm_content_number_pages"),
                       p("pwm_cover_surface_weight"), p("pwm_cover_number_pages")).alias("katalog_gewicht_gesamt"),
    )


def _offers(cat, keys) -> DataFrame:
    """A row per plan row and branch, in output columns without the costs; not yet deduplicated."""
    number = F.explode(F.array(*[
        F.struct(F.lit(BRANCHES[k][2]).alias("data_source"), F.col(BRANCHES[k][1]).alias("wbkz")) for k in keys]))
    return derived(cat["print_plan"]).select(
        "initiative_name", "project_name_corr", "shipping_type", "season",
        F.col("pwm_season_financial_year").alias("season_year"), F.col("pwm_pages_total").alias("pages_total"),
        F.col("pwm_circulation_plan").alias("circulation_plan"),
        F.col("pwm_circulation_actual").alias("circulation_actual"),
        F.col("pwm_new_test").alias("is_test"), "katalog_gewicht_gesamt", number.alias("_number"),
    ).select("*", "_number.data_source", "_number.wbkz").drop("_number")


def _with_costs(cat, keys, offers: DataFrame) -> DataFrame:
    """Distinct offers with the distinct costs of their order number: the rows are distinct.

    Costs are dealt by range, so equal rows meet without a second hash exchange.
    """
    columns = ("data_source", "auftrag", "kostenartenbeschreibung", "costs")
    costs = union_all([cat[BRANCHES[k][0]].select(
        F.lit(BRANCHES[k][2]).alias("data_source"), "auftrag",
        F.col("kostenartenbes").alias("kostenartenbeschreibung"), F.col("wert_overall").alias("costs")) for k in keys])
    costs = costs.repartitionByRange(*columns).distinct().withColumnRenamed("data_source", "_source")
    j = offers.distinct().join(costs, (F.col("data_source") == F.col("_source")) & (F.col("wbkz") == F.col("auftrag")), "left")
    return j.withColumn("costs", F.col("costs").cast("double"))


def branch(cat, cfg: ReportConfig, key: str) -> DataFrame:
    """One branch as written: DISTINCT rows incl. helper columns (without the id)."""
    return _with_costs(cat, (key,), _offers(cat, (key,))).select(*BRANCH_COLUMNS)


def report(cat, cfg: ReportConfig) -> DataFrame:
    # the report keeps only rows with an order number
    offers = _offers(cat, KEYS).filter(F.col("wbkz").isNotNull()).select(
        "initiative_name", "project_name_corr", "shipping_type", "season_year", "data_source", "wbkz",
        F.coalesce(F.col("pages_total"), F.lit(0)).alias("pages_total"), "circulation_plan", "circulation_actual",
        F.coalesce(F.col("katalog_gewicht_gesamt"), F.lit(0.0)).alias("katalog_gewicht_gesamt"))
    return _with_costs(cat, KEYS, offers).select(*REPORT_COLUMNS)


def project(cat, cfg: ReportConfig) -> DataFrame:
    """Operator key catalog_project: project clean-up and season per distinct plan value."""
    plan = cat["print_plan"].select("project_name", "pwm_season_financial_year").distinct()
    return plan.select(
        "project_name", project_name_corr(F.col("project_name")).alias("project_name_corr"),
        F.col("pwm_season_financial_year").alias("season_year"),
        season(F.col("pwm_season_financial_year")).alias("season"))


def weight(cat, cfg: ReportConfig) -> DataFrame:
    """Operator key catalog_weight: weight per plan row (NULL kept here)."""
    return derived(cat["print_plan"]).select(
        "initiative_name", "project_name", "pwm_shipping_type", "pwm_format_height", "pwm_format_width",
        "katalog_gewicht_gesamt")


def ids(cat, cfg: ReportConfig) -> DataFrame:
    """Operator key catalog_id: helper id per project, season and shipping type."""
    d = derived(cat["print_plan"]).select("project_name_corr", "season", "shipping_type").distinct()
    return d.withColumn("id", catalog_id(F.col("project_name_corr"), F.col("season"), F.col("shipping_type")))
