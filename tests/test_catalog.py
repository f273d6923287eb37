"""The stored catalog: its contract, and reports over it."""

import pytest
from pyspark.sql import functions as F

from support import SF_SMALL
from spendlens.plans import display, search
from spendlens.sources.catalog import SOURCES, check_source, fixture_catalog, parquet_catalog


@pytest.mark.parametrize("name", sorted(SOURCES))
def test_fixture_sources_keep_the_contract(spark, name):
    source = fixture_catalog(spark, SF_SMALL)[name]
    assert check_source(name, source).columns == list(SOURCES[name][1])


def test_faults_are_named(spark):
    source = fixture_catalog(spark, SF_SMALL)["google_keyword_perf"]
    with pytest.raises(ValueError, match="clicks is missing"):
        check_source("google_keyword_perf", source.drop("clicks"))
    with pytest.raises(ValueError, match="date_col is string, not date"):
        check_source("google_keyword_perf", source.withColumn("date_col", F.col("date_col").cast("string")))


def test_reports_over_stored_sources(spark, cfg, tmp_path):
    derived = fixture_catalog(spark, SF_SMALL)
    wanted = ["google_keyword_perf", "planning_context_map", "adition_partner_perf", "adition_ad_identifier_map"]
    for name in wanted:
        derived[name].withColumn("other", F.lit(1)).write.parquet(f"{tmp_path}/{name}")
    stored = parquet_catalog(spark, str(tmp_path))
    for build in (lambda c: search.branch(c, cfg, "sea_google_keyword"), lambda c: display.branch(c, cfg, "dis_adition_partner")):
        assert sorted(build(stored).collect(), key=str) == sorted(build(derived).collect(), key=str)


#: Sources that could stand in for each other: one money column of each.
ALIKE = (
    {"google_keyword_perf": "cost_euro", "google_dsa_perf": "cost_euro", "bing_keyword_perf": "cost_euro",
     "bing_keyword_perf_legacy": "cost_euro", "bing_dsa_perf": "cost_euro", "adition_display_perf": "dsp_costs",
     "adition_partner_perf": "budget", "google_ads_ad_perf": "costs_in_euro", "google_ad_perf": "cost_euro",
     "odin_ad_perf": "net_revenue_euro", "bing_ad_perf": "cost_euro", "facebook_ad_perf": "cost_euro",
     "pinterest_pin_perf": "cost_euro", "snap_ad_perf": "cost_euro", "tiktok_ad_perf": "cost_euro"},
    {"affiliate_costs_awin": "nw_provision_hr", "affiliate_costs_private_network": "nw_provision_hr"},
    {"tv_flights": "cost_euro_nnn", "radio_marketer": "cost_euro_nnn", "radio_webradio": "cost_euro_nnn"},
    {"print_creation_cost": "wert_overall", "print_creative_cost": "wert_overall", "print_shipping_cost": "wert_overall"},
)


@pytest.mark.parametrize("alike", ALIKE, ids=lambda a: next(iter(a)))
def test_swapped_sources_show(spark, alike):
    """Each has values of its own, so reading another in its place turns a key red."""
    cat = fixture_catalog(spark, SF_SMALL)
    sums = {name: cat[name].agg(F.sum(column)).first()[0] for name, column in alike.items()}
    assert len(set(sums.values())) == len(alike)


def test_id_groups_grow_with_the_data(spark):
    """Group keys of the digital chain and the clicks follow the tables' sizes; what joins stays in proportion."""
    small, large = (fixture_catalog(spark, f"/root/testdata/{sf}") for sf in ("sf0.001", "sf0.01"))
    for name, key in (("digital_mediaplan", "adgap_ids"), ("adgap_id_mapping", "adgap_id"), ("tracking_call_campaign_link", "campaign_h_sk")):
        a, b = (c[name].select(key).distinct().count() for c in (small, large))
        assert 4 * a < b
    per_group = [c["digital_mediaplan"].groupBy("adgap_ids").count().agg(F.max("count")).first()[0] for c in (small, large)]
    assert per_group == [10, 10]
