"""Report sinks: day-partitioned Parquet behind a committed manifest.

A write makes a new data folder with the days it rebuilt; the manifest then says for every day which
folder holds it. The commit is the only step that readers see, so a report is replaced as a whole
or not at all, days that lost their rows included.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from .manifest import Manifest

DAY = "reporting_date"
NULL_DAY = "__HIVE_DEFAULT_PARTITION__"


def on_days(days: list[dt.date | None]) -> Column:
    """Rows of these report days. Literals, so they reach the partition filters of the sources."""
    dated = [d for d in days if d is not None]
    test = F.col(DAY).isin(dated) if dated else F.lit(False)
    return (test | F.col(DAY).isNull()) if None in days else test


def touched_days(days: DataFrame) -> list[dt.date | None]:
    """The distinct days of a ``reporting_date`` column; the calendar bounds them."""
    return [d for (d,) in days.select(F.col(DAY).cast("date")).distinct().collect()]


def _name(day: dt.date | None) -> str:
    return day.isoformat() if day else NULL_DAY


def write_report(df: DataFrame, path: str, days: DataFrame | list | None = None) -> None:
    """Write a report partitioned by ``reporting_date`` and commit it.

    Without ``days`` the whole report is replaced, so days that left it go. With ``days`` (a DataFrame
    with a ``reporting_date`` column, or a list of days) only those days are rebuilt, from rows filtered
    to them: Catalyst takes the filter through the union and below the day-keyed aggregations to
    the scans. A rebuilt day without rows goes; other days stay in the folders they are in.

    Rows are brought together by day before writing (large days are split by AQE), so a
    day is a few files, not one per task.
    """
    manifest = Manifest(df.sparkSession, path)
    number, state = manifest.read()
    kept = {}
    if days is not None:
        days = days if isinstance(days, list) else touched_days(days)
        if not days:
            return
        df = df.filter(on_days(days))
        rebuilt = {_name(d) for d in days}
        kept = {d: f for d, f in state.get("days", {}).items() if d not in rebuilt}
    folder = manifest.new_folder()
    df.hint("rebalance", DAY).write.partitionBy(DAY).parquet(manifest.data(folder))
    written = [n.split("=", 1)[1] for n in manifest.names(f"data/{folder}") if n.startswith(f"{DAY}=")]
    manifest.commit(number, {"schema": df.schema.json(), "days": kept | dict.fromkeys(written, folder)})


def read_report(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """The committed report: the newest state, or an earlier one by its number."""
    import json

    manifest = Manifest(spark, path)
    _, state = manifest.read(number)
    if not state:
        raise FileNotFoundError(f"no report has been committed under {path}")
    schema = StructType.fromJson(json.loads(state["schema"]))
    if not state["days"]:
        return spark.createDataFrame([], schema)
    folders = [f"{manifest.data(f)}/{DAY}={d}" for d, f in sorted(state["days"].items())]
    stored = StructType([*schema.fields]).add("write_id", StringType())
    return spark.read.schema(stored).option("basePath", f"{manifest.root}/data").parquet(*folders).select(schema.names)


def vacuum_report(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Remove folders that none of the newest ``keep`` states uses."""
    return Manifest(spark, path).vacuum(lambda state: state.get("days", {}).values(), keep)
