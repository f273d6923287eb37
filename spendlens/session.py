"""SparkSession with the settings the reports are tuned for."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


#: Sides measured at run time to be no larger than this are broadcast; no plan forces a broadcast.
BROADCAST_BYTES = 32 << 20


def get_spark(master: str | None = None, shuffle_partitions: int | None = None, app: str = "spendlens",
              shared: str | None = None) -> SparkSession:
    """Session for local runs and tests.

    AQE re-plans joins and coalesces shuffle partitions from measured sizes;
    skew-join splitting is on for hot campaign ids. The UI stays off. ``shared``
    is the folder for ``spark.checkpoint.dir``.
    """
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    master = master or f"local[{cpus}]"
    parts = shuffle_partitions or cpus
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.autoBroadcastJoinThreshold", str(BROADCAST_BYTES))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("SPENDLENS_DRIVER_MEMORY", "16g"))
    )
    if shared:
        builder = builder.config("spark.checkpoint.dir", shared)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Executors and a restarted driver must see it, so there is no default."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    spark.sparkContext.setCheckpointDir(d)
    return d
