"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows handed to Python at once. Texts may be long, so batches stay small.
ARROW_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_own_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share, from ``spark.checkpoint.dir``.

    Where it is unset, a local master (tests, a laptop) gets a folder of its own;
    a cluster must name one.
    """
    folder = spark.conf.get("spark.checkpoint.dir", "")
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        app = spark.sparkContext.applicationId
        folder = _own_folders.get(app) or _own_folders.setdefault(app, tempfile.mkdtemp(prefix="llm-"))
    return folder.rstrip("/")


def stored(df: DataFrame, label: str, **options) -> DataFrame:
    """``df`` written to a new table in the shared folder and read again.

    Cuts lineage: a lost executor costs the tasks it was running, and work that two
    later steps need is done once.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{label}-{uuid.uuid4().hex}"
    df.write.options(compression="zstd", **options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def utf8(column) -> F.Column:
    """Text as UTF-8 bytes; null as empty."""
    return F.coalesce(column.cast("string"), F.lit("")).cast("binary")


_kept: dict[str, object] = {}


def kept_by_worker(name: str, make):
    """What ``make()`` gives, made once per Python worker and ``name``; the worker keeps the last one only."""
    if name not in _kept:
        _kept.clear()
        _kept[name] = make()
    return _kept[name]
