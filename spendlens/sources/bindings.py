"""Fixture bindings: source tables derived from the TPC-H-like test data.

The reports read marketing tables that ship with no data. For testing and
benchmarking, each source is *derived* by Spark from the tables under
``/root/testdata/sf*/`` with portable SQL, so the same text runs in Spark
(``spark.sql(text, lineitem=df, ...)``) and, inlined as CTEs, in the DuckDB oracle.
The work of every report therefore grows with the scale factor of the data.

Rules: ``||`` rather than ``concat``; explicit DECIMAL casts on money and rates so
both engines see the same types; no ``current_date``.
"""

from __future__ import annotations

import re

# campaign id generator: residue mod 12 decides the markers (see FIXTURES.md)
_CAMP = (
    "CASE {k} % 12"
    " WHEN 0 THEN 'c' || cast({k} as string) || '-50.WS-TW.BC-SA.C-'"
    " WHEN 1 THEN 'c' || cast({k} as string) || '-25.FS-PF.BC-D.C-'"
    " WHEN 2 THEN 'c' || cast({k} as string) || '-W.BC-D.C-'"
    " WHEN 3 THEN 'c' || cast({k} as string) || '-F.BC-D.C-'"
    " WHEN 4 THEN 'c' || cast({k} as string) || '-SS.AG-x-D.C-'"
    " WHEN 5 THEN 'c' || cast({k} as string) || '-SES.C-'"
    " WHEN 6 THEN 'c' || cast({k} as string) || '-B.AC-'"
    " WHEN 7 THEN 'c' || cast({k} as string) || '-B.ACX'"
    " WHEN 8 THEN NULL"
    " WHEN 9 THEN 'c' || cast({k} as string) || '-TW.BC-'"
    " WHEN 10 THEN 'c' || cast({k} as string) || '-SA.C-x'"
    " ELSE 'c' || cast({k} as string) || '-plain' END"
)


def camp(key: str) -> str:
    return _CAMP.replace("{k}", key)


BINDINGS: dict[str, str] = {
    # ad performance fact; NULL impressions, all-zero rows and negative costs are deliberate
    "fx_perf": f"""
SELECT cast(l_shipdate as date) AS reporting_date, {camp('l_partkey')} AS camp_id,
 CASE WHEN l_linenumber = 7 THEN NULL WHEN l_quantity = 1 THEN 0 ELSE cast(l_quantity * 10 as bigint) END AS impressions,
 CASE WHEN l_quantity = 1 THEN 0 ELSE cast(l_quantity as bigint) END AS clicks,
 cast(CASE WHEN l_quantity = 1 THEN 0 WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN -l_extendedprice ELSE l_extendedprice END as decimal(18,2)) AS cost_euro,
 CASE l_suppkey % 8 WHEN 0 THEN 'App Install Retargeting' WHEN 1 THEN 'app install performance' WHEN 2 THEN 'Retargeting REW'
  WHEN 3 THEN 'Web Prospecting' WHEN 4 THEN 'Performance Traffic' WHEN 5 THEN 'performance conversion dynamisch' WHEN 6 THEN 'CLT WKZ' END AS campaign_name,
 100 + l_suppkey % 5 AS account_id, 'Acct ' || cast(100 + l_suppkey % 5 as string) AS account_name,
 1 + l_suppkey % 4 AS customer_id, l_suppkey AS adgroup_id, l_partkey AS bid FROM {{lineitem}}""",
    # planning context; a NULL key for every third part (those campaigns stay unmapped), some
    # NULL channels, two or three rows for some campaigns
    "fx_map": f"""
SELECT CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE {camp('p_partkey')} END AS camp_id, 'PC-' || p_brand AS planning_context_code,
 CASE WHEN p_partkey % 2 = 0 THEN 'AWIN' WHEN p_partkey % 5 = 0 THEN 'Private Network' ELSE p_type END AS planning_context_name,
 CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE 'Chan ' || p_type END AS channel_name FROM {{part}}
UNION ALL
SELECT {camp('p_partkey')}, 'PX-' || p_brand, CASE WHEN p_partkey % 2 = 0 THEN 'AWIN' ELSE 'Private Network' END, 'Chan A'
FROM {{part}} WHERE p_partkey % 8 = 5 OR p_partkey % 16 = 2
UNION ALL
SELECT {camp('p_partkey')}, 'PX-' || p_brand, CASE WHEN p_partkey % 2 = 0 THEN 'AWIN' ELSE 'Private Network' END, 'Chan A'
FROM {{part}} WHERE p_partkey % 16 = 5""",
    # banner -> campaign, with expired rows and '-1' unknowns; some banners have two valid
    # rows, some campaigns several banners
    "fx_ident": f"""
SELECT p_partkey AS bid, CASE WHEN p_partkey % 11 = 0 THEN '-1' ELSE {camp('p_partkey')} END AS campaign_id,
 CASE WHEN p_partkey % 4 = 0 THEN timestamp '2000-01-01 00:00:00' ELSE timestamp '2099-01-01 00:00:00' END AS banner_known_until_utc FROM {{part}}
UNION ALL
SELECT CASE WHEN p_partkey % 2 = 0 THEN p_partkey ELSE p_partkey + 100000000 END, {camp('p_partkey')},
 timestamp '2099-01-01 00:00:00' FROM {{part}} WHERE p_partkey % 6 < 2""",
    # ad-group -> campaign, reported for a day and the two after it; duplicates on purpose, the operator deduplicates
    "fx_adgroup": """
SELECT date_col, account_id, adgroup_id, CASE WHEN adgroup_id % 3 = 0 THEN NULL ELSE 'ag' || cast(adgroup_id as string) END AS camp_id
FROM (SELECT cast(l_shipdate as date) AS date_col, 100 + l_suppkey % 5 AS account_id, l_suppkey AS adgroup_id FROM {lineitem}
 UNION ALL SELECT cast(l_shipdate as date) + 1, 100 + l_suppkey % 5, l_suppkey FROM {lineitem}
 UNION ALL SELECT cast(l_shipdate as date) + 2, 100 + l_suppkey % 5, l_suppkey FROM {lineitem}) a""",
    # affiliate provisions; NULL and zero provisions
    "fx_aff_cost": f"""
SELECT o_orderdate AS order_timestamp, {camp('o_custkey')} AS camp_id,
 cast(CASE WHEN o_orderkey % 9 = 0 THEN 0 WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_totalprice END as decimal(18,2)) AS nw_provision_hr,
 cast(CASE WHEN o_orderkey % 9 = 0 THEN 0 ELSE o_orderkey % 7 END as decimal(18,2)) AS nw_networkfee_hr FROM {{orders}}""",
    # affiliate fix costs: intervals of 1..30 days
    "fx_fixcost": f"""
SELECT {camp('o_custkey')} AS campaign, cast(o_totalprice as decimal(18,2)) AS cost_euro, cast(o_orderkey % 30 + 1 as int) AS duration_in_days,
 cast(o_orderdate as date) AS start_date, cast(o_orderdate as date) + cast(o_orderkey % 30 as int) AS end_date,
 CASE WHEN o_orderkey % 4 = 0 THEN 'false' ELSE 'true' END AS additional_costs FROM {{orders}}""",
    # tracking calls; events are January 2024, moved back 23 years into the order period
    "fx_call": """
SELECT event_id AS call_sk, ts - INTERVAL 23 YEAR AS event_created_at_utc, CASE WHEN event_type = 'error' THEN true ELSE false END AS bot FROM {events}""",
    "fx_call_link": """
SELECT event_id AS call_sk, CASE WHEN event_id % 10 = 0 THEN -1 ELSE event_id % (SELECT count(*) FROM {part}) + 1 END AS campaign_sk FROM {events}""",
    # some campaign ids stand in two rows
    "fx_campaign_h": f"""
SELECT p_partkey AS campaign_sk, {camp('p_partkey')} AS campaign_id FROM {{part}}
UNION ALL
SELECT p_partkey + 100000000, {camp('p_partkey')} FROM {{part}} WHERE p_partkey % 5 = 2""",
    # broadcast actuals (TV / radio); mixed-case names carry the _WKZ_ and _VERTRIEB_ markers;
    # every third order has no campaign name
    "fx_actual": """
SELECT cast(o_orderdate as date) AS actual_date, cast(o_orderdate as date) + CASE WHEN o_orderkey % 6 = 0 THEN 1 ELSE 0 END AS end_date,
 CASE WHEN o_orderkey % 3 = 0 THEN NULL WHEN o_custkey % 4 = 0 THEN 'Spot_WKZ_a' WHEN o_custkey % 4 = 1 THEN 'spot_Vertrieb_b'
  WHEN o_custkey % 4 = 2 THEN 'Spot_VERTRIEB_c' ELSE 'spot_d' END AS campaign_name,
 cast(o_totalprice as decimal(18,2)) AS cost_euro_nnn, cast(o_orderkey % 50 as decimal(18,4)) AS contacts FROM {orders}""",
    # plan; overlaps the actuals on part of their (date, campaign) keys; odd orders have no
    # campaign name
    "fx_plan": """
SELECT cast(l_shipdate as date) AS planning_date,
 CASE WHEN l_orderkey % 2 = 1 THEN NULL WHEN l_orderkey % 4 = 0 THEN 'SPOT_wkz_a' ELSE 'spot_vertrieb_c' END AS campaign_name,
 CASE l_orderkey % 3 WHEN 0 THEN 'wkz' WHEN 1 THEN 'Vertrieb' ELSE NULL END AS budget_origin,
 CASE l_linenumber % 3 WHEN 0 THEN 'TV' WHEN 1 THEN 'Webradio' ELSE 'Hörfunk' END AS channel,
 cast(l_extendedprice as decimal(18,2)) AS cost_euro_nnn_planned, cast(l_quantity as bigint) AS gross_contacts_planned FROM {lineitem}""",
    # agency fees by (month, channel, sub channel), TV twice in every 4th month; every 5th
    # month has no fee values
    "fx_fee": """
SELECT cast(ym as string) AS year_month, ch AS channel_branding, sub AS sub_channel_branding,
 CASE WHEN ym % 5 = 0 THEN NULL ELSE cast(cast(ym % 7 as decimal(9,4)) / 100 as decimal(9,4)) END AS fee,
 CASE WHEN ym % 5 = 0 THEN NULL ELSE cast(cast(ym % 3 as decimal(9,4)) / 10 as decimal(9,4)) END AS discount,
 CASE WHEN ym % 5 = 0 THEN NULL ELSE cast(0.02 as decimal(9,4)) END AS managed_fee,
 CASE WHEN ym % 5 = 0 THEN NULL ELSE cast(0.03 as decimal(9,4)) END AS dsp_fee
FROM (
 SELECT ym, 'TV' AS ch, cast(NULL as string) AS sub FROM m
 UNION ALL SELECT ym, 'TV', 'Second' FROM m WHERE ym % 4 = 0
 UNION ALL SELECT ym, 'Funk', cast(NULL as string) FROM m
 UNION ALL SELECT ym, 'Digital', 'IO' FROM m
 UNION ALL SELECT ym, 'Digital', 'Programmatic' FROM m
 UNION ALL SELECT ym, 'Digital', 'Other' FROM m
 UNION ALL SELECT ym, '(D)OOH', '(D)OOH' FROM m
 UNION ALL SELECT ym, '(D)OOH', 'Programmatic (D)OOH' FROM m
) c""",
    # digital media plan: ten placements per id group, of 1..60 days, the last ones past the run's day; zero volumes and NULL creative types are deliberate
    "fx_mediaplan": """
SELECT 'g' || cast(cast(floor(p_partkey / 10.0) as bigint) as string) AS adgap_ids,
 CASE p_partkey % 4 WHEN 0 THEN 'Branding' WHEN 1 THEN 'WKZ' WHEN 2 THEN 'Vertrieb' ELSE 'Intern' END AS campaign_scope,
 CASE p_partkey % 4 WHEN 0 THEN 'ATV' WHEN 1 THEN 'OLV' WHEN 2 THEN 'DISPLAY BRANDING' ELSE 'Audio' END AS channel,
 CASE p_partkey % 6 WHEN 0 THEN 'Addressable TV' WHEN 1 THEN 'Display' WHEN 2 THEN 'olv' WHEN 3 THEN 'Programmatic' WHEN 4 THEN 'Digital Radio' ELSE 'Native' END AS media_type,
 CASE p_partkey % 5 WHEN 0 THEN 'CPM' WHEN 1 THEN 'vCPM' WHEN 2 THEN 'CPC' ELSE 'Fix' END AS media_billing_type,
 CASE WHEN p_partkey % 13 = 0 THEN NULL WHEN p_partkey % 17 = 0 THEN 'Sonderkombination' ELSE 'Banner' END AS media_creative_type, p_brand AS client,
 DATE '1997-01-01' + cast(p_partkey * 7 % 1650 as int) AS placement_start_cet, DATE '1997-01-01' + cast(p_partkey * 7 % 1650 + p_size as int) AS placement_end_cet,
 CASE WHEN p_partkey % 19 = 0 THEN 0 ELSE p_partkey % 1000 END AS target_group_size,
 cast(p_retailprice as decimal(18,2)) AS daily_media_cost_nnn_euro FROM {part}""",
    "fx_adition": """
SELECT CASE WHEN l_linenumber % 4 = 0 THEN NULL ELSE 'b' || cast(cast(floor(l_partkey / 8.0) as bigint) as string) END AS banner_external_id,
 'b' || cast(l_suppkey as string) AS campaign_external_id, cast(l_shipdate as date) AS reporting_date,
 cast(l_quantity as bigint) AS clicks, cast(l_quantity * 10 as bigint) AS impressions FROM {lineitem}""",
    # ad-gap ids of eight parts each, so some belong to two groups; every 4th also to a group further on
    "fx_adgap": """
SELECT DISTINCT 'b' || cast(cast(floor(p_partkey / 8.0) as bigint) as string) AS adgap_id,
 'g' || cast(cast(floor(p_partkey / 10.0) as bigint) as string) AS adgap_ids FROM {part}
UNION ALL
SELECT DISTINCT 'b' || cast(cast(floor(p_partkey / 8.0) as bigint) as string), 'g' || cast(cast(floor(p_partkey / 10.0) as bigint) + 2 as string)
FROM {part} WHERE floor(p_partkey / 8.0) % 4 = 1""",
    # out-of-home costs
    "fx_dooh": """
SELECT l_shipdate AS planning_date, CASE l_suppkey % 3 WHEN 0 THEN 'city_wkz_x' WHEN 1 THEN 'city_Vertrieb' ELSE 'city' END AS campaign_name,
 CASE l_linenumber WHEN 1 THEN 'Progr. Media' WHEN 2 THEN 'Versand' WHEN 3 THEN NULL ELSE 'Media' END AS cost_type,
 cast(l_extendedprice as decimal(18,2)) AS cost_euro_nn_without_bonus,
 cast(cast(l_extendedprice as decimal(18,2)) * (1 - cast(l_discount as decimal(4,2))) as decimal(18,4)) AS cost_euro_nnn FROM {lineitem}""",
    # exchange rates: no rate value on some days, like a weekday-only publication; two rows on
    # every 5th day of a month
    "fx_rate": """
SELECT DISTINCT cast(o_orderdate as date) AS reporting_date,
 CASE WHEN extract(day FROM o_orderdate) % 7 = 0 THEN NULL
  ELSE cast(1 + extract(month FROM o_orderdate) / 100.0 as decimal(9,4)) END AS exchange_rate_eur_to_usd
FROM {orders}
UNION ALL
SELECT DISTINCT cast(o_orderdate as date), cast(0.5 as decimal(9,4)) FROM {orders} WHERE extract(day FROM o_orderdate) % 5 = 0""",
    # catalogue plan; the project-name regex has match, no-match and prefix-only cases
    "fx_print": """
SELECT 'init' || cast(p_partkey % 20 as string) AS initiative_name,
 CASE p_partkey % 5 WHEN 0 THEN '23GJ_Sommer-Highlights_' || cast(p_partkey % 3 as string) WHEN 1 THEN '24GJ_Mode' WHEN 2 THEN '23GJ_' WHEN 3 THEN '23GJ__x' ELSE 'Plain_' || p_type END AS project_name,
 CASE p_partkey % 3 WHEN 0 THEN 'Package' WHEN 1 THEN 'Mail' END AS shipping_type, CASE p_partkey % 4 WHEN 0 THEN '23/24' WHEN 1 THEN 'FY23' ELSE '24/25' END AS season_year,
 CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE 'o' || cast(p_partkey % 90 as string) END AS opp_wbkz, CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE 'o' || cast(p_partkey % 70 as string) END AS ppc_wbkz,
 'o' || cast(p_partkey % 50 as string) AS wbkz, CASE WHEN p_partkey % 6 = 0 THEN NULL ELSE p_size END AS pages_total, p_size * 100 AS circulation_plan, p_size * 90 AS circulation_actual,
 p_partkey % 2 AS is_test, cast(p_size + 10 as double) AS height, cast(p_size + 5 as double) AS width, CASE WHEN p_partkey % 8 = 0 THEN NULL ELSE cast(60 as double) END AS content_weight,
 cast(p_size * 2 as double) AS content_pages, cast(120 as double) AS cover_weight, cast(4 as double) AS cover_pages FROM {part}""",
    # catalogue costs: several cost types per order number
    "fx_print_cost": """
SELECT 'o' || cast(s_suppkey % 60 as string) AS auftrag, CASE s_suppkey % 3 WHEN 0 THEN 'Druck' WHEN 1 THEN 'Papier' ELSE 'Porto' END AS kostenartenbes,
 cast(s_acctbal as decimal(18,2)) AS wert_overall FROM {supplier}""",
}



_COLUMNS = {"fx_perf": "reporting_date camp_id impressions clicks cost_euro campaign_name account_id account_name customer_id adgroup_id bid",
            "fx_aff_cost": "order_timestamp camp_id nw_provision_hr nw_networkfee_hr",
            "fx_actual": "actual_date end_date campaign_name cost_euro_nnn contacts",
            "fx_print_cost": "auftrag kostenartenbes wert_overall"}


def _variant(of: str, **changed: str) -> str:
    """A table of its own: another binding's rows with some columns computed differently (no rows go)."""
    return "\nSELECT " + ", ".join(f"{changed[c]} AS {c}" if c in changed else c for c in _COLUMNS[of].split()) + f" FROM ({BINDINGS[of]}) v"


def _scaled(column: str, by: str) -> str:
    return f"cast({column} * {by} as decimal(18,2))"


# every source is a table of its own, with values that differ from the others'
for _name, _clicks, _cost in (("fx_dsa", "clicks + 1", "2"), ("fx_bing", "clicks + 2", "3"),
                              ("fx_bing_legacy", "clicks + 3", "5"), ("fx_bing_dsa", "clicks + 4", "7")):
    BINDINGS[_name] = _variant("fx_perf", clicks=_clicks, cost_euro=_scaled("cost_euro", _cost))
for _name, _by in (("fx_banner", "11"), ("fx_partner", "13"), ("fx_ace", "17"), ("fx_gads", "19"), ("fx_odin", "23"),
                   ("fx_bing_ads", "29"), ("fx_facebook", "31"), ("fx_pinterest", "37"), ("fx_snap", "41"), ("fx_tiktok", "43")):
    BINDINGS[_name] = _variant("fx_perf", impressions=f"impressions * {_by}", clicks=f"clicks * {_by}", cost_euro=_scaled("cost_euro", _by))
BINDINGS["fx_pn_cost"] = _variant("fx_aff_cost", nw_provision_hr=_scaled("nw_provision_hr", "2"))
for _name, _by in (("fx_radio", "2"), ("fx_webradio", "3")):
    BINDINGS[_name] = _variant("fx_actual", cost_euro_nnn=_scaled("cost_euro_nnn", _by),
                               contacts=f"cast(contacts + {_by} as decimal(18,4))")
for _name, _by in (("fx_creative_cost", "2"), ("fx_shipping_cost", "3")):
    BINDINGS[_name] = _variant("fx_print_cost", wert_overall=_scaled("wert_overall", _by))

# months of the fee table; a CTE of the fee binding
FEE_MONTHS = """
SELECT DISTINCT extract(year FROM o_orderdate) * 100 + extract(month FROM o_orderdate) AS ym FROM {orders}"""

def referenced_tables(sql: str) -> list[str]:
    return sorted(set(re.findall(r"\{(\w+)\}", sql)))


def spark_binding(spark, name: str, base: dict):
    """Run one binding on Spark with the base DataFrames as SQL arguments."""
    if name == "fx_fee":
        months = spark.sql(FEE_MONTHS, orders=base["orders"])
        text = BINDINGS[name].replace(" FROM m", " FROM {m}")
        return spark.sql(text, m=months)
    text = BINDINGS[name]
    return spark.sql(text, **{t: base[t] for t in referenced_tables(text)})


def duckdb_with_clause(names) -> str:
    """WITH-clause text that defines the named bindings over DuckDB views."""
    parts = []
    for name in names:
        text = BINDINGS[name]
        if name == "fx_fee":
            parts.append("fx_fee_m AS (" + FEE_MONTHS.format(orders="orders") + ")")
            text = text.replace(" FROM m", " FROM fx_fee_m")
        text = text.format(**{t: t for t in referenced_tables(text)})
        parts.append(f"{name} AS ({text})")
    return "WITH " + ",\n".join(parts)
