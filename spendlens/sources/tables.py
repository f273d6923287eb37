"""Sources as tables: partitioned by day, facts that join each other bucketed by the key.

A table's schema, partitions and buckets come from the session's metastore, so opening the
catalog and building a report read nothing; the folders of a table are listed when a plan is
executed, and only those of the days that the report's filters leave. Facts bucketed by the same
key into the same number of buckets are joined bucket by bucket, without moving either.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import contract
from .catalog import SOURCES, Catalog, check_source

#: Buckets of a bucketed table; choose them so that a day's bucket is some 100 MB or more.
BUCKETS = 8


def _prepared(name: str, df: DataFrame) -> DataFrame:
    day = contract.DAY.get(name)
    if contract.day_partition(name) == contract.SOURCE_DAY:
        df = df.withColumn(contract.SOURCE_DAY, F.to_date(F.col(day).cast("timestamp_ntz")))
    return df


def write_table(name: str, df: DataFrame, database: str, buckets: int = BUCKETS, mode: str = "overwrite") -> None:
    """Write a source as the table ``database.name`` in its declared layout (``mode`` "append" adds rows).

    Rows are brought together by day (and bucket) first, so a day is a few files and not one per task.
    """
    rows = _prepared(name, df)
    day, key = contract.day_partition(name), contract.BUCKETED.get(name)
    if key:
        # a task holds one bucket: one file per day and bucket
        rows = rows.repartition(buckets, key)
    elif day:
        rows = rows.hint("rebalance", day)
    writer = rows.write.format("parquet").mode(mode)
    if day:
        writer = writer.partitionBy(day)
    if key:
        writer = writer.bucketBy(buckets, key).sortBy(key)
    writer.saveAsTable(f"{database}.{name}")


def install_tables(catalog: Catalog, database: str, names: Iterable[str] = tuple(SOURCES), buckets: int = BUCKETS) -> None:
    """Write the sources of another catalog as tables."""
    catalog.spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name in names:
        write_table(name, catalog[name], database, buckets)


def _buckets(spark: SparkSession, table: str, key: str) -> int | None:
    """The table's number of buckets if it is bucketed by the key alone."""
    spec = spark._jsparkSession.sessionState().catalog().getTableMetadata(
        spark._jsparkSession.sessionState().sqlParser().parseTableIdentifier(table)).bucketSpec()
    if spec.isEmpty():
        return None
    columns = spec.get().bucketColumnNames()
    return spec.get().numBuckets() if columns.size() == 1 and columns.head().lower() == key else None


def table_catalog(spark: SparkSession, database: str) -> Catalog:
    """Sources as the tables ``database.{logical name}`` of the session's metastore."""
    buckets = {}
    for name, key in contract.BUCKETED.items():
        table = f"{database}.{name}"
        if spark.catalog.tableExists(table) and (n := _buckets(spark, table, key)):
            buckets[name] = n
    return Catalog(spark, lambda name: check_source(name, spark.table(f"{database}.{name}")), buckets)
