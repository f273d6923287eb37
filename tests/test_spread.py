"""Running sums over intervals against a row per day."""

import datetime as dt
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from support import SF_SMALL
from spendlens.operators.spread import explode_days, running_days
from spendlens.plans import affiliate, branding
from spendlens.sources.catalog import fixture_catalog

DAY = dt.date(2024, 2, 20)
LO, HI = DAY + dt.timedelta(days=2), DAY + dt.timedelta(days=25)
SCHEMA = "k string, j int, a date, b date, v decimal(18,2), n bigint"
days = st.integers(0, 30).map(lambda i: DAY + dt.timedelta(days=i))
ROW = st.tuples(st.sampled_from(["x", "y", None]), st.sampled_from([1, None]), st.one_of(st.none(), days), st.one_of(st.none(), days),
                st.one_of(st.none(), st.decimals(-99, 99, places=2)), st.one_of(st.none(), st.integers(-5, 5)))


def by_days(df, keys):
    return (explode_days(df, "a", "b", LO, HI).groupBy(*keys, "day")
            .agg(F.sum("v").alias("v"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("n_rows")))


def by_changes(df, keys):
    return running_days(df, keys, "a", "b", LO, HI, {"v": F.col("v"), "n": F.col("n")})


def rows_of(df, keys):
    return sorted(map(tuple, df.select(*keys, "day", "v", "n", "n_rows").collect()), key=str)


@settings(max_examples=25, deadline=None)
@given(st.lists(ROW, max_size=12))
def test_any_intervals(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    for keys in (["k"], ["k", "j"]):
        assert rows_of(by_changes(df, keys), keys) == rows_of(by_days(df, keys), keys)


def test_sums_are_exact_over_long_intervals(spark):
    """A third of a cent added on one day and taken away on another leaves nothing behind."""
    rows = [("x", 1, DAY, DAY + dt.timedelta(days=i % 40), Decimal(i) / 100, i) for i in range(2000)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("v", (F.col("v") / F.lit(3).cast("decimal(10,0)")))
    got = {r.day: r.v for r in by_changes(df, ["k"]).collect()}
    assert got == {r.day: r.v for r in by_days(df, ["k"]).collect()}


def test_doubles_are_refused(spark):
    df = spark.createDataFrame([("x", 1, DAY, DAY, None, 1)], SCHEMA)
    with pytest.raises(ValueError):
        running_days(df, ["k"], "a", "b", LO, HI, {"v": F.col("v").cast("double")})


def test_two_rows_per_interval_before_the_shuffle(spark):
    """What enters the aggregation is two changes per interval, however long it is."""
    df = spark.createDataFrame([("x", 1, DAY, dt.date(2044, 1, 1), Decimal(1), 1), ("y", 1, DAY, DAY, Decimal(1), 1)], SCHEMA)
    out = running_days(df, ["k"], "a", "b", DAY, dt.date(2044, 1, 1), {"v": F.col("v")})
    plan = out._jdf.queryExecution().executedPlan().toString()
    generates = [line for line in plan.split("\n") if "Generate" in line]
    assert len(generates) == 2 and "sequence" in generates[0] and "array" in generates[1]
    assert "sequence" not in plan[plan.index("Exchange"):]
    assert out.count() == (dt.date(2044, 1, 1) - DAY).days + 2


def test_fix_costs_at_report_grain(spark, cfg):
    cat = fixture_catalog(spark, SF_SMALL)
    want = affiliate.fixcost_daily(cat, cfg).groupBy("reporting_date", "camp_id").agg(F.sum("cost").alias("cost"))
    got = affiliate.fixcost_sums(cat, cfg).select("reporting_date", "camp_id", "cost")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


@pytest.mark.parametrize("build", [affiliate.report, branding.report, branding.booked_leg])
def test_reports_spread_by_changes(spark, cfg, build):
    """No row per interval and day enters a shuffle: day sequences are only made from a running state."""
    plan = build(fixture_catalog(spark, SF_SMALL), cfg)._jdf.queryExecution().optimizedPlan().toString().split("\n")
    for at, line in enumerate(plan):
        if "Generate explode(sequence" in line:
            assert any("Window" in below for below in plan[at + 1:at + 6])
