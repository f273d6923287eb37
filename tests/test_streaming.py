"""Incremental refresh: only the days present in new fact files are rewritten."""

import os
import tempfile
import uuid

import pytest
from pyspark.sql import functions as F

from support import SF_SMALL
from spendlens.plans import search
import datetime as dt

from spendlens.session import checkpoint_dir
from spendlens.sources.sinks import read_report, write_report
from spendlens.sources.catalog import fixture_catalog
from spendlens.streaming.refresh import cet_day, interval_days, same_day, start_refresh


def test_refresh_rewrites_only_touched_days(spark, cfg):
    work = tempfile.mkdtemp(prefix="spendlens-stream-")
    facts, target = os.path.join(work, "facts"), os.path.join(work, "report")
    cat = fixture_catalog(spark, SF_SMALL)
    perf = cat["google_keyword_perf"]
    full = search.report(cat, cfg)
    days = [r.reporting_date for r in full.select("reporting_date").distinct().orderBy("reporting_date").limit(3).collect()]
    # an arriving file touches the first two of those days
    perf.filter(F.col("date_col").isin(days[:2])).write.parquet(facts)
    q = start_refresh(spark, facts, perf.schema, same_day("date_col"), lambda: search.report(fixture_catalog(spark, SF_SMALL), cfg),
                      target, name=f"sea-test-{uuid.uuid4().hex}")
    q.awaitTermination(300)
    out = read_report(spark, target)
    written = sorted(r.reporting_date for r in out.select("reporting_date").distinct().collect())
    assert written == days[:2]
    expect = full.filter(F.col("reporting_date").isin(days[:2]))
    assert out.count() == expect.count()
    assert out.agg(F.sum("cost_euro")).first()[0] == pytest.approx(expect.agg(F.sum("cost_euro")).first()[0])


def _days(path, spark):
    return {str(r.reporting_date): r.n for r in read_report(spark, path).groupBy("reporting_date").agg(F.count("*").alias("n")).collect()}


def _rows(spark, *days):
    return spark.createDataFrame([(dt.date.fromisoformat(d), i) for i, d in enumerate(days)], "reporting_date date, n int")


def test_full_write_replaces_and_emptied_days_go(spark):
    path = tempfile.mkdtemp(prefix="spendlens-sink-") + "/report"
    write_report(_rows(spark, "2024-01-01", "2024-01-02", "2024-01-03", "2024-01-03"), path)
    write_report(_rows(spark, "2024-01-02", "2024-01-02", "2024-01-09"), path,
                 days=_rows(spark, "2024-01-02", "2024-01-03"))
    assert _days(path, spark) == {"2024-01-01": 1, "2024-01-02": 2}
    write_report(_rows(spark, "2024-01-05"), path)
    assert _days(path, spark) == {"2024-01-05": 1}


def test_days_are_brought_together_before_writing(spark):
    path = tempfile.mkdtemp(prefix="spendlens-sink-") + "/report"
    write_report(_rows(spark, *["2024-01-01", "2024-01-02", "2024-01-03"] * 40).repartition(6), path)
    files = [f for _, _, names in os.walk(path) for f in names if f.endswith(".parquet")]
    assert len(files) == 3


def test_touched_days(spark):
    calls = spark.createDataFrame([("2024-03-30 23:30:00",), ("2024-07-01 10:00:00",)], "t string") \
        .select(F.col("t").cast("timestamp_ntz").alias("t"))
    assert [str(r[0]) for r in cet_day("t")(calls).collect()] == ["2024-03-31", "2024-07-01"]
    plans = spark.createDataFrame([(dt.date(2024, 1, 1), dt.date(2024, 1, 3))], "a date, b date")
    got = interval_days("a", "b", dt.date(2024, 1, 2), dt.date(2024, 12, 31))(plans).collect()
    assert [str(r[0]) for r in got] == ["2024-01-02", "2024-01-03"]


def test_shared_folder_must_be_named():
    class Unset:
        class conf:
            get = staticmethod(lambda key, default=None: default)

    with pytest.raises(ValueError):
        checkpoint_dir(Unset)
