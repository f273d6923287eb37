"""Schema-first sources: no job before a report runs, day partitions prune, bucketed facts don't move."""

import datetime as dt
import re
import uuid

import pytest
from pyspark.sql import functions as F

from support import SF_SMALL
from spendlens.plans import affiliate, branding, display, registry, search
from spendlens.sources import contract
from spendlens.sources.catalog import SOURCES, Catalog, fixture_catalog, parquet_catalog
from spendlens.sources.tables import install_tables, table_catalog, write_table

CLICKS = ["tracking_calls", "tracking_call_campaign_link", "campaign_hub", "planning_context_map"]


def jobs_of(spark, run):
    """Jobs that ``run`` starts."""
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, group)
    try:
        run()
        return list(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def few_days(spark):
    """The sources of some weeks (a table folder per day), facts of all kinds of day column among them."""
    base = fixture_catalog(spark, SF_SMALL)

    def load(name):
        df, day = base[name], contract.DAY.get(name)
        if day is None:
            return df
        lo = dt.date(2001, 1, 1) if name == "tracking_calls" else dt.date(2000, 2, 20)
        return df.filter(F.col(day).cast("date").between(F.lit(lo), F.lit(lo + dt.timedelta(days=25))))

    return Catalog(spark, load)


@pytest.fixture(scope="module")
def tables(spark, few_days):
    database = f"sources_{uuid.uuid4().hex[:8]}"
    names = ["google_keyword_perf", "affiliate_costs_awin", "dooh_perf", "bpn_planning", "tv_flights", "agency_fee", *CLICKS]
    install_tables(few_days, database, names, buckets=4)
    yield database
    spark.sql(f"DROP DATABASE {database} CASCADE")


@pytest.mark.parametrize("key", sorted(registry.builders()))
def test_no_job_from_opening_the_catalog_to_the_plan(spark, cfg, key):
    assert jobs_of(spark, lambda: registry.builders()[key](fixture_catalog(spark, SF_SMALL), cfg)) == []


def test_no_job_over_stored_sources(spark, cfg, tmp_path):
    derived = fixture_catalog(spark, SF_SMALL)
    for name in ("google_keyword_perf", "planning_context_map"):
        derived[name].write.parquet(f"{tmp_path}/{name}")
    assert jobs_of(spark, lambda: search.branch(parquet_catalog(spark, str(tmp_path)), cfg, "sea_google_keyword")) == []


def test_no_job_over_tables(spark, cfg, tables):
    def build():
        cat = table_catalog(spark, tables)
        return search.branch(cat, cfg, "sea_google_keyword"), affiliate.branch(cat, cfg, "aff_clicks"), branding.branch(cat, cfg, "bra_dooh")

    assert jobs_of(spark, build) == []


def test_types_can_be_declared(spark, tmp_path):
    spark.createDataFrame([(dt.date(2000, 1, 1), "c", 1, 2, 3)], "date_col date, camp_id string, impressions int, clicks bigint, cost_euro bigint") \
        .write.parquet(f"{tmp_path}/google_keyword_perf")
    cat = parquet_catalog(spark, str(tmp_path), types={"google_keyword_perf": {"impressions": "int", "cost_euro": "bigint"}})
    assert cat["google_keyword_perf"].collect()[0] == (dt.date(2000, 1, 1), "c", 1, 2, 3)


def test_every_source_has_a_declared_layout():
    assert set(contract.DAY) <= set(SOURCES) and set(contract.BUCKETED) <= set(SOURCES)
    for name, day in contract.DAY.items():
        assert day in SOURCES[name][1]
        assert contract.declared(name, day) in ("date", "timestamp_ntz")


def partition_filters(df):
    text = df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    return re.findall(r"PartitionFilters: \[(.+)\]", text)


@pytest.mark.parametrize("build, column", [
    (lambda c, cfg: search.branch(c, cfg, "sea_google_keyword"), "date_col"),                     # floor
    (lambda c, cfg: affiliate.branch(c, cfg, "aff_awin_cost"), contract.SOURCE_DAY),              # rolling window
    (lambda c, cfg: affiliate.branch(c, cfg, "aff_clicks"), contract.SOURCE_DAY),                 # window on CET days
    (lambda c, cfg: branding.branch(c, cfg, "bra_tv"), "broadcast_date"),                         # up to yesterday, outer join
    (lambda c, cfg: branding.branch(c, cfg, "bra_tv"), "planning_date"),
    (lambda c, cfg: branding.branch(c, cfg, "bra_dooh"), contract.SOURCE_DAY),                    # year floor
])
def test_day_filters_are_partition_filters(spark, cfg, tables, build, column):
    assert any(column in f for f in partition_filters(build(table_catalog(spark, tables), cfg)))


def test_closed_range_prunes(spark, cfg, few_days):
    database = f"legacy_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {database}")
    try:
        for name in ("bing_keyword_perf_legacy", "planning_context_map"):
            write_table(name, few_days[name], database)
        found = partition_filters(search.branch(table_catalog(spark, database), cfg, "sea_bing_keyword_legacy"))
        assert any(">=" in f and "<=" in f for f in found)
    finally:
        spark.sql(f"DROP DATABASE {database} CASCADE")


def test_only_the_days_asked_for_are_read(spark, tables):
    day = dt.date(2000, 3, 1)
    df = table_catalog(spark, tables)["google_keyword_perf"].filter(F.col("date_col") == F.lit(day))
    assert df.inputFiles() and all("date_col=2000-03-01" in f for f in df.inputFiles())


def test_dynamic_pruning_by_a_joined_side(spark, tables):
    """A fact joined on its day to a filtered side reads the days of that side only."""
    cat = table_catalog(spark, tables)
    facts, days = cat["google_keyword_perf"], cat["tv_flights"].filter(F.col("tv_flight_name") == "spot_d").select("broadcast_date")
    df = facts.join(days, facts["date_col"] == days["broadcast_date"], "left_semi")
    assert "dynamicpruning" in plan_of(df)


def test_reports_over_tables(spark, cfg, few_days, tables):
    cat = table_catalog(spark, tables)
    for build in (lambda c: search.branch(c, cfg, "sea_google_keyword"), lambda c: affiliate.branch(c, cfg, "aff_awin_cost"),
                  lambda c: affiliate.branch(c, cfg, "aff_clicks"), lambda c: branding.branch(c, cfg, "bra_dooh"),
                  lambda c: affiliate.click_sums(c, cfg)):
        got = rows_of(build(cat))
        assert got and got == rows_of(build(few_days))


def below_fact_join(plan):
    """The lines of the plan below the join on the call key."""
    lines = plan.split("\n")
    at = next(i for i, x in enumerate(lines) if "Join" in x and "external_call_h_sk" in x)
    depth = lambda x: len(x) - len(x.lstrip(" :+-*()0123456789"))
    below = []
    for line in lines[at + 1:]:
        if depth(line) <= depth(lines[at]):
            break
        below.append(line)
    return "\n".join(below)


@pytest.fixture
def no_broadcast(spark):
    """Tables as large as in production: none is broadcast."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def test_bucketed_facts_join_without_exchange(spark, cfg, tables, few_days, no_broadcast):
    cat = table_catalog(spark, tables)
    assert cat.colocated("tracking_calls", "tracking_call_campaign_link")
    for build in (affiliate.clicks, affiliate.click_sums):
        below = below_fact_join(plan_of(build(cat, cfg)))
        assert "Scan parquet" in below and "Exchange" not in below
    assert not few_days.colocated("tracking_calls", "tracking_call_campaign_link")
    assert "Exchange" in below_fact_join(plan_of(affiliate.clicks(few_days, cfg)))


def test_different_buckets_are_not_colocated(spark, cfg, few_days):
    database = f"mixed_{uuid.uuid4().hex[:8]}"
    install_tables(few_days, database, CLICKS, buckets=2)
    try:
        write_table("tracking_call_campaign_link", few_days["tracking_call_campaign_link"], database, buckets=3)
        cat = table_catalog(spark, database)
        assert not cat.colocated("tracking_calls", "tracking_call_campaign_link")
        assert rows_of(affiliate.branch(cat, cfg, "aff_clicks")) == rows_of(affiliate.branch(few_days, cfg, "aff_clicks"))
    finally:
        spark.sql(f"DROP DATABASE {database} CASCADE")


def test_late_days_are_appended(spark, cfg, few_days):
    database = f"late_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {database}")
    try:
        source = few_days["affiliate_costs_awin"]
        old = F.col("order_timestamp").cast("date") < F.lit(dt.date(2000, 3, 1))
        write_table("planning_context_map", few_days["planning_context_map"], database)
        write_table("affiliate_costs_awin", source.filter(old), database)
        write_table("affiliate_costs_awin", source.filter(~old), database, mode="append")
        cat = table_catalog(spark, database)
        assert rows_of(affiliate.branch(cat, cfg, "aff_awin_cost")) == rows_of(affiliate.branch(few_days, cfg, "aff_awin_cost"))
    finally:
        spark.sql(f"DROP DATABASE {database} CASCADE")


def test_display_reads_its_own_days(spark, cfg, few_days):
    assert display.branch(few_days, cfg, "dis_gdn").count() > 0
