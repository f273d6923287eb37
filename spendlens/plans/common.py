"""Helpers shared by the report builders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import ReportConfig
from ..functions.budget import with_budget
from ..operators.context import campaign_dimension, condensed_context, planning_context
from ..operators.unions import union_all

CHANNEL_VIEW = (
    "reporting_date", "planning_context_code", "planning_context_name", "channel", "camp_id",
    "source_system", "impressions", "clicks", "cost_euro", "budget_logic", "budget_logic_share",
)


def label(cfg: ReportConfig, source: str) -> str:
    """Lineage label: the environment and the source's label (by default its logical name)."""
    return f"{cfg.env}_{cfg.labels.get(source, source)}"


def context_for(cat, cfg: ReportConfig, distinct: bool) -> DataFrame:
    """Condensed planning context; AQE picks the join by its measured size."""
    return condensed_context(planning_context(cat["planning_context_map"], distinct))


def campaigns_for(cat, distinct: bool) -> DataFrame:
    """The campaign dimension of a report: condensed context and budget classes, once per campaign."""
    return campaign_dimension(planning_context(cat["planning_context_map"], distinct), cat["campaign_persist"])


def channel_view(branches: list[DataFrame]) -> DataFrame:
    """Union the branches and classify the budget; money cast to DOUBLE last."""
    u = union_all(branches)
    return with_budget(u).select(*CHANNEL_VIEW).withColumn("cost_euro", F.col("cost_euro").cast("double"))
