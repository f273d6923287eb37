"""Physical-plan checks and invariants of the reports."""

import pytest
from pyspark.sql import functions as F

from support import SF_SMALL
from spendlens.plans import registry
from spendlens.sources.catalog import fixture_catalog

REPORTS = ("report_sea", "report_display", "report_social", "report_affiliate", "report_branding",
           "report_seasonal_cost")


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def built(spark, cfg):
    b = registry.builders()
    return {k: b[k](fixture_catalog(spark, SF_SMALL), cfg) for k in REPORTS}


@pytest.mark.parametrize("key", REPORTS)
def test_no_nested_loop_or_cartesian_join(built, key):
    text = plan_text(built[key])
    assert "BroadcastNestedLoopJoin" not in text and "CartesianProduct" not in text


@pytest.mark.parametrize("key", ("report_sea", "report_display", "report_social"))
def test_channel_rollups_stay_hash_aggregates(built, key):
    """The fact rollup by (day, campaign) is a hash aggregate with partial sums.

    The only sort aggregate allowed is the dimension-side condensing of the
    planning context (one row per campaign id).
    """
    text = plan_text(built[key])
    assert "HashAggregate(keys=[reporting_date" in text
    assert "SortAggregate(key=[reporting_date" not in text
    for line in text.split("\n"):
        if "SortAggregate(" in line:
            assert "SortAggregate(key=[camp_id" in line, line


def test_seasonal_report_has_one_shuffle(built):
    text = plan_text(built["report_seasonal_cost"])
    assert text.count("Exchange hashpartitioning") == 1


def test_filters_reach_the_scan(built):
    text = plan_text(built["report_sea"])
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThanOrEqual(l_shipdate" in text


def test_unique_mapping_keeps_total_cost(spark, cfg):
    """With a mapping unique per campaign, enrichment does not change the total."""
    from spendlens.operators.rollup import activity
    from spendlens.plans import search
    from spendlens.sources.catalog import Catalog

    base = fixture_catalog(spark, SF_SMALL)
    cat = Catalog(spark, lambda n: base[n].dropDuplicates(["camp_id"]) if n == "planning_context_map" else base[n])
    branch = search.branch(cat, cfg, "sea_google_keyword")
    facts = (cat["google_keyword_perf"].filter(F.col("date_col") >= F.lit(cfg.min_date))
             .filter(activity([F.col("impressions"), F.col("cost_euro"), F.col("clicks")], strict=True)))
    assert branch.agg(F.sum("cost_euro")).first()[0] == facts.agg(F.sum("cost_euro")).first()[0]


def test_capped_cost_never_exceeds_booked(spark, cfg):
    q = registry.queries()["effective_media_cost"](spark, SF_SMALL)
    bad = q.filter(F.col("kosten_nnn").isNotNull() & (F.col("media_cost") > F.col("kosten_nnn"))).count()
    assert bad == 0


def test_reports_scale_with_input(spark, cfg):
    """Doubling every source doubles the sums of a channel view (no hidden caps)."""
    from spendlens.plans import search
    from spendlens.sources.catalog import Catalog

    base = fixture_catalog(spark, SF_SMALL)
    doubled = Catalog(spark, lambda n: base[n] if n == "planning_context_map" else base[n].unionByName(base[n]))
    one = search.report(base, cfg).agg(F.sum("cost_euro"), F.sum("clicks")).first()
    two = search.report(doubled, cfg).agg(F.sum("cost_euro"), F.sum("clicks")).first()
    assert two[0] == pytest.approx(2 * one[0]) and two[1] == 2 * one[1]


@pytest.mark.parametrize("key", sorted(registry.builders()))
def test_building_a_plan_runs_no_job(spark, cfg, key):
    cat = fixture_catalog(spark, SF_SMALL)
    for name in cat:
        cat[name]  # schemas are read from files here
    sc = spark.sparkContext
    group = f"build-{key}"
    sc.setJobGroup(group, group)
    try:
        registry.builders()[key](cat, cfg)
        assert list(sc.statusTracker().getJobIdsForGroup(group)) == []
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("key", ("report_sea", "report_display", "report_social", "report_affiliate"))
def test_budget_classes_come_from_the_campaign_dimension(built, key):
    """Classes are derived in the dimension's subtree; a report row derives its own only where that has none."""
    plan = built[key]._jdf.queryExecution().optimizedPlan().toString().split("\n")
    searching = [line for line in plan if "regexp_substr" in line or "RegExpSubStr" in line.replace(" ", "") or "-TW.BC-" in line and "instr" in line]
    assert searching
    in_rows = [line for line in searching if "campaign_logic" in line and "reporting_date" in line]
    for line in in_rows:
        assert "CASE WHEN isnotnull(campaign_logic" in line
    assert any("reporting_date" not in line for line in searching)


def test_campaigns_unknown_to_the_dimension_are_classified(spark, cfg):
    """Without campaign table and mapping the classes are the same."""
    from spendlens.plans import search
    from spendlens.sources.catalog import Catalog

    base = fixture_catalog(spark, SF_SMALL)
    bare = Catalog(spark, lambda n: base[n].limit(0) if n == "campaign_persist" else
                   base[n].filter(F.col("camp_id").like("c1%")) if n == "planning_context_map" else base[n])
    pick = lambda cat: {r.camp_id: (r.budget_logic, r.budget_logic_share)
                        for r in search.report(cat, cfg).select("camp_id", "budget_logic", "budget_logic_share").distinct().collect()}
    assert pick(bare) == pick(base)
