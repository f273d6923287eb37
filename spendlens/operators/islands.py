"""Gaps and islands: runs of consecutive days as intervals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def day_islands(df: DataFrame, keys: list[str], day: str) -> DataFrame:
    """keys, ``first_day``, ``last_day``: a row per run of consecutive days on which a key occurs.

    One shuffle: days are collected per key as a set, map-side first, so repeated rows don't
    travel; a key's set is at most the calendar. NULL keys are keys, NULL days are dropped.
    """
    days = (df.filter(F.col(day).isNotNull()).groupBy(*keys)
            .agg(F.sort_array(F.collect_set(F.unix_date(F.col(day).cast("date")))).alias("_days")))
    run = days.select(
        *keys,
        F.filter("_days", lambda d, i: (i == 0) | (F.get("_days", i - 1) != d - 1)).alias("_first"),
        F.filter("_days", lambda d, i: (i == F.size("_days") - 1) | (F.get("_days", i + 1) != d + 1)).alias("_last"))
    each = run.select(*keys, F.explode(F.arrays_zip("_first", "_last")).alias("_run"))
    return each.select(*keys, F.date_from_unix_date("_run._first").alias("first_day"),
                       F.date_from_unix_date("_run._last").alias("last_day"))
