"""Interval -> days: spread a row valid from ``start`` to ``end`` over its days.

``explode_days`` gives every row's days; ``running_days`` gives sums per key and day without
making a row per day first, and ``running_spans`` the spans of days with the same sums.

The reference joins a generated calendar to the interval table with
``DATUM BETWEEN START AND END`` (a range join; Spark would plan a nested-loop
join). Here every interval is first clipped to the report window, rows with an
empty overlap are dropped (``sequence`` would count *down* for start > end),
and the days are produced by ``explode(sequence(lo, hi))``: a map-side
operation with no shuffle, whose output size is the number of overlapping days.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def clip_filter(start: Column, end: Column, lo: dt.date, hi: dt.date) -> Column:
    """Interval overlaps [lo, hi]; a plain range predicate, pushed to Parquet."""
    return (start <= F.lit(hi)) & (end >= F.lit(lo))


def explode_days(df: DataFrame, start: str, end: str, lo: dt.date, hi: dt.date, out: str = "day") -> DataFrame:
    """One row per day of ``[start, end]`` inside ``[lo, hi]``."""
    first = F.greatest(F.col(start), F.lit(lo))
    last = F.least(F.col(end), F.lit(hi))
    return (
        df.filter(clip_filter(F.col(start), F.col(end), lo, hi))
        .filter(first <= last)
        .withColumn(out, F.explode(F.sequence(first, last)))
    )


def running_days(df: DataFrame, keys: list[str], start: str, end: str, lo: dt.date, hi: dt.date,
                 sums: dict[str, Column], out: str = "day") -> DataFrame:
    """Sums of the rows that are valid on a day, per key and day of [lo, hi]: keys, ``out``, the sums, ``n_rows``."""
    spans = running_spans(df, keys, start, end, lo, hi, sums)
    return spans.select(*keys, F.explode(F.sequence("first_day", "last_day")).alias(out), *sums, "n_rows")


def running_spans(df: DataFrame, keys: list[str], start: str, end: str, lo: dt.date, hi: dt.date,
                  sums: dict[str, Column]) -> DataFrame:
    """The same per key and span of days without a change: keys, first_day, last_day, the sums, ``n_rows``.

    Difference encoding: an interval becomes two changes, plus its values on its first day and minus on
    the day after its last, so two rows per interval enter the aggregation (map-side) however long it is.
    Changes are summed per key and day, a running sum gives the state from each change to the next;
    days are filled in later. A key's changes are at most one per day of the calendar, so the window
    holds no more than that even for a key that has a third of all rows.

    ``sums`` are whole numbers or DECIMALs, so what is added is taken away exactly. As in SUM, NULLs are
    skipped and a day with only NULLs is NULL; NULL keys are a group.
    """
    first = F.greatest(F.col(start), F.lit(lo))
    last = F.least(F.col(end), F.lit(hi))
    rows = (df.filter(clip_filter(F.col(start), F.col(end), lo, hi)).filter(first <= last)
            .select(*keys, first.alias("_first"), last.alias("_last"), *[v.alias(c) for c, v in sums.items()]))
    for column, type_ in rows.dtypes[len(keys) + 2:]:
        if not type_.startswith(("decimal", "bigint", "int")):
            raise ValueError(f"{column} is {type_}: running sums need exact numbers")
    changes = rows.select(*keys, *sums, F.explode(F.array(
        F.struct(F.col("_first").alias("day"), F.lit(1).alias("sign")),
        F.struct(F.date_add("_last", 1).alias("day"), F.lit(-1).alias("sign")))).alias("_at"))
    plus = F.col("_at.sign") > 0
    daily = changes.groupBy(*keys, F.col("_at.day").alias("_day")).agg(
        F.sum("_at.sign").alias("_n"),
        *[F.sum(F.when(plus, F.col(c)).otherwise(-F.col(c))).alias(c) for c in sums],
        *[F.sum(F.when(F.col(c).isNotNull(), F.col("_at.sign")).otherwise(0)).alias(f"_n_{c}") for c in sums])
    ordered = Window.partitionBy(*keys).orderBy("_day")
    so_far = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    states = daily.select(
        *keys, F.col("_day").alias("first_day"), F.date_sub(F.lead("_day").over(ordered), 1).alias("last_day"), F.sum("_n").over(so_far).alias("n_rows"),
        *[F.when(F.sum(f"_n_{c}").over(so_far) > 0, F.sum(F.coalesce(F.col(c), F.lit(0))).over(so_far)).alias(c) for c in sums])
    return states.filter(F.col("n_rows") > 0).select(*keys, "first_day", "last_day", *sums, "n_rows")
