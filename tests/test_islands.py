"""Runs of days, and the ad-group override built on them."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from support import SF_SMALL, literal_catalog
from spendlens.operators.islands import day_islands
from spendlens.plans import display
from spendlens.sources.catalog import fixture_catalog

DAY = dt.date(2024, 2, 25)


def slow(rows):
    """Runs per key by walking the sorted days."""
    out = []
    for key in {k for k, d in rows if d is not None}:
        days = sorted({d for k, d in rows if k == key and d is not None})
        first = days[0]
        for a, b in zip(days, [*days[1:], None]):
            if b is None or (b - a).days > 1:
                out.append((key, first, a))
                first = b
    return sorted(out, key=str)


@settings(max_examples=20, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["x", "y", None]), st.one_of(st.none(), st.integers(0, 12).map(lambda i: DAY + dt.timedelta(days=i)))), max_size=25))
def test_any_days(spark, rows):
    df = spark.createDataFrame(rows, "k string, d date")
    assert sorted(map(tuple, day_islands(df, ["k"], "d").collect()), key=str) == slow(rows)


def test_a_mapping_that_holds_is_one_row(spark):
    days = spark.range(1000).select(F.date_add(F.lit(DAY), F.col("id").cast("int")).alias("d"), F.lit("ag").alias("k"))
    assert day_islands(days.unionAll(days), ["k"], "d").collect() == [("ag", DAY, DAY + dt.timedelta(days=999))]


def test_mapping_side_is_a_fraction_of_its_rows(spark, cfg):
    cat = fixture_catalog(spark, "/root/testdata/sf0.01")
    source = cat["bing_adgroup_perf"].filter(F.col("camp_id").isNotNull() & (F.col("bing_account_id") == cfg.bing_audience_account)
                                             & (F.col("date_col") >= F.lit(cfg.min_date)))
    rows, distinct, runs = source.count(), source.distinct().count(), display.adgroup_campaigns(cat, cfg).count()
    assert 3 * runs < distinct < rows


def test_days_in_gaps_keep_their_own_campaign(spark, cfg):
    acct = cfg.bing_audience_account
    day = lambda i: cfg.min_date + dt.timedelta(days=i)
    perf = spark.createDataFrame([(day(i), "own", 7, acct, 10, 1, 5) for i in range(6)] + [(day(1), "own", None, acct, 10, 1, 5)],
                                 "date_col date, camp_id string, bing_adgroup_id long, bing_account_id long, impressions long, clicks long, cost_euro long")
    adg = spark.createDataFrame([(day(i), acct, 7, "ag") for i in (0, 1, 1, 4)] + [(day(1), acct, 7, "other"), (day(2), acct + 1, 7, "ag"), (day(3), acct, 7, None)],
                                "date_col date, bing_account_id long, bing_adgroup_id long, camp_id string")
    base = fixture_catalog(spark, SF_SMALL)
    cat = literal_catalog(spark, {"bing_ad_perf": perf, "bing_adgroup_perf": adg, "planning_context_map": base["planning_context_map"]})
    got = sorted((r.reporting_date, r.camp_id, r.clicks) for r in display.branch(cat, cfg, "dis_bing_audience").collect())
    assert got == sorted([(day(0), "ag", 1), (day(1), "ag", 1), (day(1), "other", 1), (day(1), "own", 1), (day(2), "own", 1),
                          (day(3), "own", 1), (day(4), "ag", 1), (day(5), "own", 1)])
