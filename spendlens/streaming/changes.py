"""Refresh after changes of dimensions: mappings, links, fees, rates, campaign tables.

A dimension has no arrival stream; what changed is the difference between its last snapshot and
now, as multisets of rows. Each source says which report days its changed rows touch, those
days are rebuilt and committed, and only then the snapshots move on, so a run that failed is
made up for by the next.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.fees import month_key
from ..plans.affiliate import cet_date
from ..sources.catalog import Catalog
from ..sources.manifest import Manifest
from ..sources.sinks import DAY, touched_days, write_report

#: Maps changed rows of a source to the report days (``reporting_date``) they touch.
Touched = Callable[[DataFrame], DataFrame]


def changed_rows(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows that occur more often in one than in the other, each once, with ``n``: how many more in ``new``.

    NULLs are equal to each other. Rows are counted map-side, so a row repeated any number of times is one
    row of the shuffle per task.
    """
    columns = new.columns
    signed = old.select(*columns, F.lit(-1).alias("n")).unionAll(new.select(*columns, F.lit(1).alias("n")))
    return signed.groupBy(*columns).agg(F.sum("n").alias("n")).filter(F.col("n") != 0)


class Snapshots:
    """The last state of each dimension that reports have been built from."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.manifest = spark, Manifest(spark, root)

    def last(self, like: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
        """The snapshot of each source, empty where there is none; schemas are those of ``like``."""
        _, state = self.manifest.read()
        return {name: self.spark.read.schema(df.schema).parquet(self.manifest.data(state[name])) if name in state
                else self.spark.createDataFrame([], df.schema) for name, df in like.items()}

    def take(self, sources: Mapping[str, DataFrame]) -> None:
        """Make these the last snapshots, all at once."""
        number, state = self.manifest.read()
        for name, df in sources.items():
            folder = self.manifest.new_folder()
            df.write.parquet(self.manifest.data(folder))
            state = state | {name: folder}
        self.manifest.commit(number, state)

    def vacuum(self, keep: int = 2) -> list[str]:
        return self.manifest.vacuum(lambda state: state.values(), keep)


# ------------------------------------------------------------ touched days by source
def day_rows(day_col: str) -> Touched:
    """Rows that hold for their own day (exchange rates, ad-group reports)."""
    return lambda changed: changed.select(F.col(day_col).cast("date").alias(DAY))


def fee_months(lo: dt.date, hi: dt.date, month_col: str = "year_month") -> Touched:
    """Fee rows touch every day of their month inside [lo, hi]."""
    def touched(changed: DataFrame) -> DataFrame:
        days = changed.sparkSession.range(1).select(
            F.explode(F.sequence(F.lit(lo), F.lit(hi))).alias(DAY)).withColumn("_month", month_key(F.col(DAY)))
        months = changed.select(F.col(month_col).cast("decimal(6,0)").cast("int").alias("_month")).distinct()
        return days.join(months, "_month", "left_semi").select(DAY)

    return touched


def campaign_days(campaign_col: str, report_days: Callable[[], DataFrame]) -> Touched:
    """A mapping or campaign row touches the days on which its campaign has rows.

    ``report_days`` gives (reporting_date, camp_id) pairs: stored day sums, or a report.
    """
    def touched(changed: DataFrame) -> DataFrame:
        campaigns = changed.select(F.col(campaign_col).alias("camp_id")).distinct()
        return report_days().join(campaigns, "camp_id", "left_semi").select(DAY)

    return touched


def call_days(cat: Catalog) -> Touched:
    """A link row touches the CET day of its call; the link may arrive long after the call."""
    def touched(changed: DataFrame) -> DataFrame:
        keys = changed.select("external_call_h_sk").distinct()
        calls = cat["tracking_calls"].select("external_call_h_sk", cet_date(F.col("event_created_at_utc")).alias(DAY))
        return calls.join(keys, "external_call_h_sk", "left_semi").select(DAY)

    return touched


def refresh_dimensions(cat: Catalog, snapshots: Snapshots, touched: Mapping[str, Touched],
                       build_report: Callable[[], DataFrame], target: str) -> list[dt.date | None]:
    """Rebuild the report days that changed dimensions touch; returns them.

    ``touched`` names the report's dimensions. The first run finds no snapshots, so all their rows
    are new.
    """
    now = {name: cat[name] for name in touched}
    before = snapshots.last(now)
    days = None
    for name, rule in touched.items():
        found = rule(changed_rows(before[name], now[name])).select(F.col(DAY).cast("date").alias(DAY))
        days = found if days is None else days.unionAll(found)
    rebuilt = touched_days(days)
    write_report(build_report(), target, rebuilt)
    snapshots.take(now)
    return rebuilt
