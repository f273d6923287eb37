"""What the sources are: declared types, day columns and bucketed keys.

Readers are built from these declarations, so opening a catalog reads no file footer and
runs no job; a file whose types differ fails when it is read. A caller whose tables hold a
column as another type declares it (``types`` of the catalogs).
"""

from __future__ import annotations

# declared type by column name
_STRING = """additional_costs adgap_id adgap_ids auftrag banner_external_id bpn_campaign_name bpn_radio_campaign_name
 budget_origin camp_id campaign campaign_external_id campaign_id campaign_scope channel channel_branding channel_name client
 cost_type facebook_campaign_name google_campaign_name initiative_name jostvonbrandis_campaign_name kostenartenbes
 media_billing_type media_creative_type media_type pinterest_campaign_name planning_context_code planning_context_name
 project_name pwm_opp_wbkz pwm_ppc_wbkz pwm_season_financial_year pwm_shipping_type pwm_wbkz snap_account_name
 snap_campaign_name sub_channel_branding tiktok_campaign_name tv_flight_name year_month"""
_DATE = """broadcast_date business_date date_col end_date placement_end_cet placement_start_cet planning_date reporting_date
 reporting_end_date reporting_start_date start_date"""
_DOUBLE = """pwm_content_number_pages pwm_content_surface_weight pwm_cover_number_pages pwm_cover_surface_weight
 pwm_format_height pwm_format_width"""
_INT = "duration_in_days pwm_pages_total pwm_circulation_plan pwm_circulation_actual"
_MONEY = """budget cost_euro cost_euro_nn_without_bonus cost_euro_nnn cost_euro_nnn_planned costs_in_euro
 daily_media_cost_nnn_euro dsp_costs net_revenue_euro nw_networkfee_hr nw_provision_hr wert_overall"""
_RATE = "discount dsp_fee exchange_rate_eur_to_usd fee managed_fee"
_VOLUME = "contacts viewers_millions_e18p"
_BY_NAME = {c: t for names, t in (
    (_STRING, "string"), (_DATE, "date"), (_DOUBLE, "double"), (_INT, "int"), (_MONEY, "decimal(18,2)"),
    (_RATE, "decimal(9,4)"), (_VOLUME, "decimal(18,4)"), ("event_created_at_utc order_timestamp", "timestamp_ntz"),
    ("banner_known_until_utc", "timestamp"), ("bot", "boolean")) for c in names.split()}
# where a source's column differs from its name's type; everything else is a whole number
_OF_SOURCE = {("dooh_perf", "planning_date"): "timestamp_ntz", ("dooh_perf", "cost_euro_nnn"): "decimal(18,4)",
              ("radio_webradio", "impressions"): "decimal(18,4)"}

#: Day column of the sources that grow by the day; tables are partitioned by it.
DAY = {
    **dict.fromkeys("google_keyword_perf google_dsa_perf bing_keyword_perf bing_keyword_perf_legacy bing_dsa_perf"
                    " google_ad_perf bing_ad_perf bing_adgroup_perf".split(), "date_col"),
    **dict.fromkeys("adition_display_perf adition_partner_perf".split(), "business_date"),
    **dict.fromkeys("google_ads_ad_perf odin_ad_perf facebook_ad_perf pinterest_pin_perf snap_ad_perf tiktok_ad_perf"
                    " radio_webradio bpn_adition_perf exchange_rates".split(), "reporting_date"),
    **dict.fromkeys("bpn_planning dooh_perf".split(), "planning_date"),
    **dict.fromkeys("affiliate_costs_awin affiliate_costs_private_network".split(), "order_timestamp"),
    "tracking_calls": "event_created_at_utc", "tv_flights": "broadcast_date", "radio_marketer": "reporting_start_date",
}
#: Partition column of a table whose day column is a timestamp: the timestamp's own (UTC) day.
SOURCE_DAY = "source_day"
#: Key that fact tables joined with each other are bucketed by, so that their join moves neither.
BUCKETED = {"tracking_calls": "external_call_h_sk", "tracking_call_campaign_link": "external_call_h_sk"}


def declared(source: str, column: str) -> str:
    """The declared type of a source's column."""
    return _OF_SOURCE.get((source, column)) or _BY_NAME.get(column, "bigint")


def day_partition(source: str) -> str | None:
    """The column that a table of the source is partitioned by: its day, or ``SOURCE_DAY``; None without a day."""
    day = DAY.get(source)
    return SOURCE_DAY if day and declared(source, day).startswith("timestamp") else day


#: The test tables' types.
BASE_TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz,"
              " o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
                " l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,"
                " l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}
