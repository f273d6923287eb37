"""Refresh the report days touched by newly arrived fact files.

A Structured Streaming file source watches a fact folder; each micro-batch
yields the set of report days it touches (see ``same_day``, ``cet_day`` and
``interval_days``; a distinct bounded by the calendar), and the report is rebuilt for exactly those days
and committed. ``streaming.sums`` does so from stored sums, without reading old facts again, and
``streaming.changes`` after changes of dimensions. Progress is kept in a checkpoint location in the shared
folder named by ``spark.checkpoint.dir``, so a restarted job resumes where it
stopped and a lost executor only repeats its tasks.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.spread import explode_days
from ..plans.affiliate import cet_date
from ..session import checkpoint_dir
from ..sources.sinks import write_report


def same_day(date_col: str) -> Callable[[DataFrame], DataFrame]:
    """Facts that change the day they carry."""
    return lambda df: df.select(F.col(date_col).cast("date").alias("reporting_date"))


def cet_day(timestamp_col: str) -> Callable[[DataFrame], DataFrame]:
    """Tracked calls: a UTC timestamp changes its CET day."""
    return lambda df: df.select(cet_date(F.col(timestamp_col)).alias("reporting_date"))


def interval_days(start: str, end: str, lo: dt.date, hi: dt.date) -> Callable[[DataFrame], DataFrame]:
    """Fix costs and media plans: a row changes every day of its interval inside [lo, hi]."""
    return lambda df: explode_days(df, start, end, lo, hi, out="reporting_date").select("reporting_date")


def start_refresh(
    spark: SparkSession,
    fact_dir: str,
    fact_schema: StructType,
    touched: Callable[[DataFrame], DataFrame],
    build_report: Callable[[], DataFrame],
    target: str,
    name: str,
    available_now: bool = True,
) -> StreamingQuery:
    """Start the refresh; ``touched`` maps fact rows to the report days they change,
    ``build_report`` returns the (lazy) full report."""
    days_stream = touched(spark.readStream.schema(fact_schema).parquet(fact_dir)).select("reporting_date")

    def per_batch(batch: DataFrame, epoch_id: int) -> None:
        write_report(build_report(), target, days=batch.distinct())

    writer = (days_stream.writeStream.foreachBatch(per_batch)
              .option("checkpointLocation", f"{checkpoint_dir(spark).rstrip('/')}/spendlens-refresh/{name}"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="5 minutes")
    return writer.start()
