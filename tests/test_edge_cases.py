"""Edge cases the bindings cannot carry, on literal in-test tables."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from support import literal_catalog
from spendlens import config
from spendlens.functions import budget as B
from spendlens.functions.catalog import project_name_corr, season
from spendlens.operators.spread import explode_days
from spendlens.plans import affiliate, branding, display, registry, search, seasonal, social
from spendlens.plans.affiliate import cet_date

D = dt.date
MONEY = T.DecimalType(18, 2)

PERF = T.StructType([
    T.StructField("date_col", T.DateType()), T.StructField("camp_id", T.StringType()),
    T.StructField("impressions", T.LongType()), T.StructField("clicks", T.LongType()),
    T.StructField("cost_euro", MONEY)])
MAP = T.StructType([
    T.StructField("channel_name", T.StringType()), T.StructField("planning_context_code", T.StringType()),
    T.StructField("planning_context_name", T.StringType()), T.StructField("camp_id", T.StringType())])
FEE = T.StructType([
    T.StructField("year_month", T.StringType()), T.StructField("channel_branding", T.StringType()),
    T.StructField("sub_channel_branding", T.StringType()), T.StructField("fee", T.DecimalType(9, 4)),
    T.StructField("discount", T.DecimalType(9, 4)), T.StructField("managed_fee", T.DecimalType(9, 4)),
    T.StructField("dsp_fee", T.DecimalType(9, 4))])


def test_duplicate_mapping_rows_fan_out_and_pick_is_deterministic(spark, cfg):
    perf = spark.createDataFrame([
        (D(1999, 5, 1), "cA-plain", 10, 1, Decimal("10.00")),
        (D(1999, 5, 1), "cA-plain", 20, 2, Decimal("5.00")),
    ], PERF)
    mapping = spark.createDataFrame([
        ("Chan", "X2", "Second", "cA-plain"),
        ("Chan", "X1", "First", "cA-plain"),
    ], MAP)
    cat = literal_catalog(spark, {"google_keyword_perf": perf, "planning_context_map": mapping})
    rows = search.branch(cat, cfg, "sea_google_keyword").collect()
    assert len(rows) == 1
    r = rows[0]
    # each mapping row repeats the campaign's rows, as the reference's LEFT JOIN does
    assert r.cost_euro == Decimal("30.00") and r.impressions == 60 and r.clicks == 6
    assert (r.planning_context_code, r.planning_context_name, r.channel) == ("X1", "First", "Chan")


def test_fee_rows_without_sub_channel_key_multiply_tv_cost(spark, cfg):
    tv = spark.createDataFrame([(D(1999, 5, 3), "Spot", Decimal("100.00"), Decimal("1.0000"))],
                               "broadcast_date date, tv_flight_name string, cost_euro_nnn decimal(18,2), viewers_millions_e18p decimal(18,4)")
    plan = spark.createDataFrame([], "planning_date date, bpn_campaign_name string, budget_origin string, channel string, "
                                     "cost_euro_nnn_planned decimal(18,2), gross_contacts_planned bigint")
    fee = spark.createDataFrame([
        ("199905", "TV", "A", Decimal("0.0100"), None, None, None),
        ("199905", "TV", "B", Decimal("0.0200"), None, None, None),
    ], FEE)
    cat = literal_catalog(spark, {"tv_flights": tv, "bpn_planning": plan, "agency_fee": fee})
    r = branding.branch(cat, cfg, "bra_tv").collect()
    assert len(r) == 1
    assert r[0].media_cost == pytest.approx(200.0)
    assert r[0].infrastructure_cost == pytest.approx(3.0)
    assert r[0].is_plan is False and r[0].camp_id == ""


def test_matched_actual_with_null_cost_keeps_null_media_and_plan_infrastructure(spark, cfg):
    tv = spark.createDataFrame([(D(1999, 5, 3), "Spot", None, Decimal("1.0000"))],
                               "broadcast_date date, tv_flight_name string, cost_euro_nnn decimal(18,2), viewers_millions_e18p decimal(18,4)")
    plan = spark.createDataFrame([(D(1999, 5, 3), "SPOT", None, "TV", Decimal("50.00"), 7)],
                                 "planning_date date, bpn_campaign_name string, budget_origin string, channel string, "
                                 "cost_euro_nnn_planned decimal(18,2), gross_contacts_planned bigint")
    fee = spark.createDataFrame([("199905", "TV", None, Decimal("0.1000"), None, None, None)], FEE)
    cat = literal_catalog(spark, {"tv_flights": tv, "bpn_planning": plan, "agency_fee": fee})
    r = branding.branch(cat, cfg, "bra_tv").collect()
    assert len(r) == 1 and r[0].is_plan is False
    assert r[0].media_cost is None and r[0].cost_euro is None
    assert r[0].infrastructure_cost == pytest.approx(5.0)
    assert r[0].impressions == pytest.approx(1_000_000.0)


def test_shared_adgap_ids_repeat_delivery_per_placement(spark, cfg):
    plan = spark.createDataFrame([
        ("g1", "Branding", "OLV", "Display", "CPM", "Banner", "c", D(1999, 5, 1), D(1999, 5, 10), 100, Decimal("10.00")),
        ("g1", "Branding", "OLV", "Display", "CPM", "Banner", "c", D(1999, 5, 1), D(1999, 5, 10), 100, Decimal("10.00")),
    ], "adgap_ids string, campaign_scope string, channel string, media_type string, media_billing_type string, "
       "media_creative_type string, client string, placement_start_cet date, placement_end_cet date, "
       "target_group_size int, daily_media_cost_nnn_euro decimal(18,2)")
    delivery = spark.createDataFrame([("b1", "x", D(1999, 5, 2), 10, 100)],
                                     "banner_external_id string, campaign_external_id string, reporting_date date, clicks bigint, impressions bigint")
    mapping = spark.createDataFrame([("b1", "g1")], "adgap_id string, adgap_ids string")
    cat = literal_catalog(spark, {"digital_mediaplan": plan, "bpn_adition_perf": delivery, "adgap_id_mapping": mapping})
    r = branding.delivered_leg(cat, cfg).collect()
    assert len(r) == 1 and r[0].clicks == 20 and r[0].impressions == 200
    assert r[0].channel == "Online Video" and r[0].media_type == "IO"


def test_zero_duration_fix_cost_gives_null_not_error(spark, cfg):
    fix = spark.createDataFrame([("cF-plain", Decimal("90.00"), 0, D(2000, 1, 1), D(2000, 1, 3), "true")],
                                "campaign string, cost_euro decimal(18,2), duration_in_days int, start_date date, end_date date, additional_costs string")
    mapping = spark.createDataFrame([], MAP)
    cat = literal_catalog(spark, {"affiliate_fixcost": fix, "planning_context_map": mapping})
    rows = affiliate.branch(cat, cfg, "aff_fixcost_daily").collect()
    assert len(rows) == 3 and all(r.cost_euro is None for r in rows)


def test_fix_cost_days_add_up_to_cost_inside_window(spark, cfg):
    fix = spark.createDataFrame([("cF-plain", Decimal("90.00"), 3, D(2000, 1, 1), D(2000, 1, 3), "true"),
                                 ("cF-plain", Decimal("50.00"), 5, D(2000, 1, 1), D(2000, 1, 5), "false")],
                                "campaign string, cost_euro decimal(18,2), duration_in_days int, start_date date, end_date date, additional_costs string")
    cat = literal_catalog(spark, {"affiliate_fixcost": fix, "planning_context_map": spark.createDataFrame([], MAP)})
    rows = affiliate.branch(cat, cfg, "aff_fixcost_daily").collect()
    assert sorted(r.reporting_date for r in rows) == [D(2000, 1, 1), D(2000, 1, 2), D(2000, 1, 3)]
    assert sum(r.cost_euro for r in rows) == pytest.approx(90.0)
    assert {r.planning_context_code for r in rows} == {"PN.MP-A.C"}


def test_leap_day_lookback():
    c = config.testing().with_(as_of=D(2024, 2, 29))
    assert c.affiliate_from == D(2022, 2, 28)


@pytest.mark.parametrize("utc,day", [
    ("2024-03-30 23:30:00", D(2024, 3, 31)),  # CET +1
    ("2024-03-31 22:30:00", D(2024, 4, 1)),   # CEST +2 after the spring change
    ("2024-10-26 22:30:00", D(2024, 10, 27)),  # still CEST
    ("2024-10-27 22:30:00", D(2024, 10, 27)),  # CET again
])
def test_click_day_in_cet(spark, utc, day):
    df = spark.createDataFrame([(utc,)], "t string").select(F.col("t").cast("timestamp_ntz").alias("t"))
    assert df.select(cet_date(F.col("t")).alias("d")).first().d == day


def test_large_account_ids_in_tiktok_rules(spark):
    prod = config.production(
        "PRD", D(2024, 1, 1), "Brand Account",
        dict(tiktok_app_install_account=9_000_000_000_000_000_001, tiktok_static_account=9_000_000_000_000_000_003),
        labels={"tiktok_ad_perf": "OWN.LABEL"})
    schema = ("reporting_date date, camp_id string, tiktok_campaign_name string, tiktok_account_id bigint, "
              "impressions bigint, clicks bigint, cost_euro decimal(18,2)")
    perf = spark.createDataFrame([
        (D(2023, 1, 1), "cT-SA.C-x", "brand", 9_000_000_000_000_000_001, 1, 1, Decimal("1.00")),
        (D(2023, 1, 1), "cU-SA.C-x", "brand", 9_000_000_000_000_000_003, 1, 1, Decimal("1.00")),
    ], schema)
    cat = literal_catalog(spark, {"tiktok_ad_perf": perf, "planning_context_map": spark.createDataFrame([], MAP)})
    rows = {r.camp_id: r for r in social.branch(cat, prod, "soc_tiktok").collect()}
    assert rows["cT-SA.C-x"].planning_context_code == "TI.MP-S.AS-APP.BT-SA.C"
    assert rows["cU-SA.C-x"].planning_context_name == "TikTok Static Ads"
    assert {r.source_system for r in rows.values()} == {"PRD_OWN.LABEL"}
    assert prod.snap_branding_account_name == "brand account"


def test_project_name_with_newline_is_left_alone(spark):
    df = spark.createDataFrame([("23GJ_Sommer_x",), ("23GJ_Som\nmer_x",), ("23GJ_",), ("Plain_x",)], "p string")
    got = [r.c for r in df.select(project_name_corr(F.col("p")).alias("c")).collect()]
    assert got == ["Sommer", "23GJ_Som\nmer_x", "23GJ_", "Plain_x"]


def test_season_without_digits_is_null(spark):
    df = spark.createDataFrame([("23/24",), ("FY23",), (None,)], "s string")
    got = [r.s for r in df.select(season(F.col("s")).alias("s")).collect()]
    assert got == [Decimal(23), None, None]


def test_budget_logic_and_share(spark):
    ids = ["c1-50.WS-TW.BC-", "c2-25.FS-PF.BC-", "c3-W.BC-", "c4-SS.AG-x-D.C-", "c5-SS.AG-", "cx.WS-TW.BC-", None,
           "c6-TW.BC-"]
    df = spark.createDataFrame([(i,) for i in ids], "camp_id string")
    got = [(r.budget_logic, r.budget_logic_share) for r in B.with_budget(df).collect()]
    assert got == [(2, 0.5), (2, 0.75), (3, 0.0), (3, 0.0), (1, 1.0), (2, None), (1, 1.0), (2, None)]
    ws = df.select(B.budget_share_ws(F.col("camp_id"), B.budget_logic(F.col("camp_id"))).alias("s")).collect()
    assert ws[1].s is None  # the branding variant has no .FS arm
    red = df.select(B.budget_logic_reduced(F.col("camp_id")).alias("l")).collect()
    assert red[1].l == 1  # no PF marker in the reduced logic


def test_reversed_interval_gives_no_days(spark):
    df = spark.createDataFrame([(D(2000, 1, 5), D(2000, 1, 1))], "s date, e date")
    assert explode_days(df, "s", "e", D(1999, 1, 1), D(2001, 1, 1)).count() == 0


def test_single_marker_row_is_in_social_and_branding_views(spark, cfg):
    """Inclusion (social) and exclusion (branding) overlap for rows with one marker."""
    schema = ("reporting_date date, camp_id string, pinterest_campaign_name string, impressions_paid bigint, "
              "clicks_paid bigint, cost_euro decimal(18,2)")
    perf = spark.createDataFrame([(D(1999, 1, 1), "cP-SA.C-x", "brand", 1, 1, Decimal("1.00"))], schema)
    persist = spark.createDataFrame([], "campaign_id string")
    cat = literal_catalog(spark, {"pinterest_pin_perf": perf, "planning_context_map": spark.createDataFrame([], MAP),
                                  "campaign_persist": persist})
    assert social.branch(cat, cfg, "soc_pinterest").count() == 1
    assert branding.branch(cat, cfg, "bra_pinterest").count() == 1


def test_results_do_not_depend_on_session_time_zone(spark, cfg):
    """Timestamp handling (CET click day, banner validity, order day) is zone-independent."""
    from support import SF_SMALL
    from spendlens.plans import registry

    qs = registry.queries(cfg)

    def snapshot():
        out = {}
        for k in ("aff_clicks", "dis_adition", "aff_awin_cost"):
            df = qs[k](spark, SF_SMALL)
            out[k] = df.agg(F.count(F.lit(1)), F.sum("clicks"), F.sum("cost_euro"),
                            F.min("reporting_date"), F.max("reporting_date")).first()
        return out

    base = snapshot()
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        other = snapshot()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert base == other


@pytest.mark.parametrize("key", (*seasonal.KEYS, None))
def test_catalogues_and_costs_are_deduplicated_before_they_meet(spark, cfg, key):
    """Repeated plan and cost rows don't multiply: no aggregate reads a join; rows without costs stay, once."""
    plan_columns = ("initiative_name string, project_name string, pwm_shipping_type string, pwm_season_financial_year string, "
                    "pwm_opp_wbkz string, pwm_ppc_wbkz string, pwm_wbkz string, pwm_pages_total bigint, "
                    "pwm_circulation_plan bigint, pwm_circulation_actual bigint, pwm_new_test bigint, pwm_format_height double, "
                    "pwm_format_width double, pwm_content_surface_weight double, pwm_content_number_pages double, "
                    "pwm_cover_surface_weight double, pwm_cover_number_pages double")
    row = lambda wbkz, pages: ("i", "Plain", "Mail", "23/24", wbkz, wbkz, wbkz, pages, 1, 1, 0, *[1.0] * 6)
    plan = spark.createDataFrame([row("o1", 0), row("o1", None), row("o2", 5), row(None, 5)] * 50, plan_columns)
    cost = spark.createDataFrame([("o1", "Druck", Decimal("2.50")), ("o1", None, None), (None, "Porto", Decimal("1.00"))] * 50,
                                 "auftrag string, kostenartenbes string, wert_overall decimal(18,2)")
    cat = literal_catalog(spark, {"print_plan": plan, **dict.fromkeys(
        ("print_creation_cost", "print_creative_cost", "print_shipping_cost"), cost)})
    out = seasonal.report(cat, cfg) if key is None else seasonal.branch(cat, cfg, key)
    got = sorted(((r.wbkz, r.pages_total, r.kostenartenbeschreibung, r.costs) for r in out.collect()), key=str)
    if key is None:
        want = [("o1", 0, "Druck", 2.5), ("o1", 0, None, None), ("o2", 5, None, None)] * 3
    else:
        want = [("o1", p, *c) for p in (0, None) for c in (("Druck", 2.5), (None, None))] + [("o2", 5, None, None), (None, 5, None, None)]
    assert got == sorted(want, key=str)
    lines = out._jdf.queryExecution().optimizedPlan().toString().split("\n")
    join = next(i for i, line in enumerate(lines) if "Join" in line)
    assert not any("Aggregate" in line for line in lines[:join])


def test_partner_sums_are_not_summed_again(spark, cfg):
    """Partner rows are summed once per day and campaign; every banner row of the campaign repeats the sums."""
    perf = spark.createDataFrame([(D(1999, 1, 1), "c1", 10, 1, Decimal("2.00")), (D(1999, 1, 1), "c1", 10, 1, Decimal("3.00")),
                                  (D(1999, 1, 2), "c2", 5, 1, Decimal("1.00")), (D(1999, 1, 2), None, 5, 1, Decimal("1.00"))],
                                 "business_date date, camp_id string, impressions bigint, clicks bigint, budget decimal(18,2)")
    banners = spark.createDataFrame([(1, "c1", dt.datetime(2099, 1, 1)), (2, "c1", dt.datetime(2099, 1, 1)), (3, None, dt.datetime(2099, 1, 1))],
                                    "bid bigint, campaign_id string, banner_known_until_utc timestamp_ntz")
    mapping = spark.createDataFrame([("x", "C", "N", "c1"), ("y", "C", "N", "c1")], MAP)
    cat = literal_catalog(spark, {"adition_partner_perf": perf, "adition_ad_identifier_map": banners, "planning_context_map": mapping})
    out = display.branch(cat, cfg, "dis_adition_partner")
    assert [(r.camp_id, r.impressions, r.clicks, r.cost_euro) for r in out.collect()] == [("c1", 80, 8, Decimal("20.00"))]
    lines = out._jdf.queryExecution().optimizedPlan().toString().split("\n")
    assert sum("Aggregate" in line and "sum(impressions" in line for line in lines) == 1


def test_affiliate_contexts_are_counted_and_nothing_is_summed_after_joins(spark, cfg):
    """Mapping rows that differ in the channel repeat a sum, also where the fallback makes them equal."""
    day = cfg.as_of - dt.timedelta(days=9)
    fix = spark.createDataFrame([(camp, Decimal("10.00"), 3, day, day + dt.timedelta(days=2), "true") for camp in ("c1", "c1", "c2", "c3", None)],
                                "campaign string, cost_euro decimal(18,2), duration_in_days int, start_date date, end_date date, additional_costs string")
    code, name = affiliate.fv.PC_PRIVATE_NETWORK
    mapping = spark.createDataFrame([("x", "C", "N", "c1"), ("y", "C", "N", "c1"), ("x", "D", "N", "c1"),
                                     ("x", None, None, "c2"), ("x", code, name, "c2")], MAP)
    cost = spark.createDataFrame([], "order_timestamp timestamp_ntz, camp_id string, nw_provision_hr decimal(18,2), nw_networkfee_hr decimal(18,2)")
    cat = literal_catalog(spark, {
        "affiliate_fixcost": fix, "planning_context_map": mapping, "affiliate_costs_awin": cost, "affiliate_costs_private_network": cost,
        "tracking_calls": spark.createDataFrame([], "external_call_h_sk bigint, event_created_at_utc timestamp_ntz, bot boolean"),
        "tracking_call_campaign_link": spark.createDataFrame([], "external_call_h_sk bigint, campaign_h_sk bigint"),
        "campaign_hub": spark.createDataFrame([], "campaign_h_sk bigint, campaign_id string"),
        "campaign_persist": spark.createDataFrame([], "campaign_id string")})
    out = affiliate.report(cat, cfg)
    third = 10 / 3
    got = {(r.camp_id, r.planning_context_code, r.planning_context_name): r.cost_euro for r in out.collect() if r.reporting_date == day}
    assert got == pytest.approx({("c1", "C", "N"): 4 * third, ("c1", "D", "N"): 2 * third, ("c2", code, name): 2 * third,
                                 ("c3", code, name): third, (None, code, name): third})
    assert out.count() == 15
    lines = out._jdf.queryExecution().optimizedPlan().toString().split("\n")
    assert not any("Aggregate" in line and "source_system" in line for line in lines)


def test_digital_level_rows_are_not_shuffled(spark, cfg):
    """Booked and delivered rows of a group meet per attribute set; fees count by month and media type; NULL groups stay."""
    day = D(1999, 5, 2)
    columns = ("adgap_ids string, campaign_scope string, channel string, media_type string, media_billing_type string, "
               "media_creative_type string, client string, placement_start_cet date, placement_end_cet date, "
               "target_group_size int, daily_media_cost_nnn_euro decimal(18,2)")
    place = lambda group, media, billing, cost, first=day: (
        group, "Branding", "OLV", media, billing, "Banner", "c", first, first, 10, Decimal(cost))
    plan = spark.createDataFrame([place("g", "Display", "CPM", "10.00"), place("g", "Display", "CPM", "30.00"), place("g", "Display", "Fix", "5.00"),
                                  place("g", "Native", "CPC", "7.00", D(1999, 6, 1)), place(None, "Display", "CPM", "9.00")], columns)
    delivery = spark.createDataFrame([("b", "x", day, 1, 2), (None, "b", day, 2, 3), ("z", "x", day, 9, 9)],
                                     "banner_external_id string, campaign_external_id string, reporting_date date, clicks bigint, impressions bigint")
    cat = literal_catalog(spark, {
        "digital_mediaplan": plan, "bpn_adition_perf": delivery,
        "adgap_id_mapping": spark.createDataFrame([("b", "g"), ("z", None)], "adgap_id string, adgap_ids string"),
        "agency_fee": spark.createDataFrame([("199905", "Digital", "IO", Decimal("0.1000"), None, None, None)] * 2, FEE)})
    out = registry.builders()["effective_media_cost"](cat, cfg)
    got = {(r.adgap_ids, r.reporting_date): (r.kosten_nnn, r.kosten_nnn_eff, r.fee) for r in out.collect()}
    # two fee rows double the sums; CPM: (10 + 30) / 20 x 2 x 5 x 2, the plain one its booked cost, June's placement nothing
    assert got == {("g", day): (pytest.approx(90.0), pytest.approx(2 * 2 * 5 * 2 + 10.0), pytest.approx(0.1)),
                   (None, day): (pytest.approx(18.0), pytest.approx(0.0), pytest.approx(0.1)),
                   ("g", D(1999, 6, 1)): (pytest.approx(7.0), pytest.approx(0.0), None)}
    lines = out._jdf.queryExecution().optimizedPlan().toString().split("\n")
    join = next(i for i, line in enumerate(lines) if "Join" in line)
    assert not any("Aggregate" in line for line in lines[:join])
