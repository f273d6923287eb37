"""Source catalog: logical table name -> DataFrame.

Report builders never open files themselves; they read from a ``Catalog``.
Column names follow the source tables the reports were written against
(lower-cased), so a production catalog only points each name at its table.
Two catalogs exist:

* ``parquet_catalog(spark, root)``: one parquet dataset per logical name
  (``sources.tables`` has the same over day-partitioned, bucketed tables);
* ``fixture_catalog(spark, sf_dir)``: the same names, derived by Spark from the
  TPC-H-like test data through the bindings in ``sources.bindings``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import contract
from .bindings import spark_binding

# logical source -> (binding, {source column: binding column or SQL expression})
SOURCES: dict[str, tuple[str, dict[str, str]]] = {
    "planning_context_map": ("fx_map", {
        "channel_name": "channel_name", "planning_context_code": "planning_context_code",
        "planning_context_name": "planning_context_name", "camp_id": "camp_id"}),
    "affiliate_costs_awin": ("fx_aff_cost", {
        "order_timestamp": "order_timestamp", "camp_id": "camp_id",
        "nw_provision_hr": "nw_provision_hr", "nw_networkfee_hr": "nw_networkfee_hr"}),
    "affiliate_costs_private_network": ("fx_pn_cost", {
        "order_timestamp": "order_timestamp", "camp_id": "camp_id", "nw_provision_hr": "nw_provision_hr"}),
    "affiliate_fixcost": ("fx_fixcost", {
        "campaign": "campaign", "cost_euro": "cost_euro", "duration_in_days": "duration_in_days",
        "start_date": "start_date", "end_date": "end_date", "additional_costs": "additional_costs"}),
    "tracking_calls": ("fx_call", {
        "external_call_h_sk": "call_sk", "event_created_at_utc": "event_created_at_utc", "bot": "bot"}),
    "tracking_call_campaign_link": ("fx_call_link", {
        "external_call_h_sk": "call_sk", "campaign_h_sk": "campaign_sk"}),
    "campaign_hub": ("fx_campaign_h", {"campaign_h_sk": "campaign_sk", "campaign_id": "campaign_id"}),
    "google_keyword_perf": ("fx_perf", {
        "date_col": "reporting_date", "camp_id": "camp_id", "impressions": "impressions",
        "clicks": "clicks", "cost_euro": "cost_euro"}),
    "google_dsa_perf": ("fx_dsa", {
        "date_col": "reporting_date", "camp_id": "camp_id", "impressions": "impressions",
        "clicks": "clicks", "cost_euro": "cost_euro"}),
    "bing_keyword_perf": ("fx_bing", {
        "date_col": "reporting_date", "camp_id": "camp_id", "impressions": "impressions",
        "clicks": "clicks", "cost_euro": "cost_euro"}),
    "bing_keyword_perf_legacy": ("fx_bing_legacy", {
        "date_col": "reporting_date", "camp_id": "camp_id", "impressions": "impressions",
        "clicks": "clicks", "cost_euro": "cost_euro"}),
    "bing_dsa_perf": ("fx_bing_dsa", {
        "date_col": "reporting_date", "camp_id": "camp_id", "impressions": "impressions",
        "clicks": "clicks", "cost_euro": "cost_euro"}),
    "adition_display_perf": ("fx_banner", {
        "business_date": "reporting_date", "bid": "bid", "dsp_impressions_bidon": "impressions",
        "dsp_clicks": "clicks", "dsp_costs": "cost_euro"}),
    "adition_ad_identifier_map": ("fx_ident", {
        "bid": "bid", "campaign_id": "campaign_id", "banner_known_until_utc": "banner_known_until_utc"}),
    "adition_partner_perf": ("fx_partner", {
        "business_date": "reporting_date", "camp_id": "camp_id", "impressions": "impressions",
        "clicks": "clicks", "budget": "cost_euro"}),
    "google_ads_ad_perf": ("fx_ace", {
        "reporting_date": "reporting_date", "camp_id": "camp_id", "impressions": "impressions",
        "clicks": "clicks", "costs_in_euro": "cost_euro", "google_account_id": "account_id"}),
    "google_ad_perf": ("fx_gads", {
        "date_col": "reporting_date", "camp_id": "camp_id", "google_campaign_name": "campaign_name",
        "impressions": "impressions", "clicks": "clicks", "cost_euro": "cost_euro", "google_account_id": "account_id"}),
    "odin_ad_perf": ("fx_odin", {
        "reporting_date": "reporting_date", "camp_id": "camp_id", "impressions": "impressions",
        "clicks": "clicks", "net_revenue_euro": "cost_euro", "odin_customer_id": "customer_id"}),
    "bing_ad_perf": ("fx_bing_ads", {
        "date_col": "reporting_date", "camp_id": "camp_id", "bing_adgroup_id": "adgroup_id",
        "bing_account_id": "account_id", "impressions": "impressions", "clicks": "clicks", "cost_euro": "cost_euro"}),
    "bing_adgroup_perf": ("fx_adgroup", {
        "date_col": "date_col", "bing_account_id": "account_id", "bing_adgroup_id": "adgroup_id", "camp_id": "camp_id"}),
    "facebook_ad_perf": ("fx_facebook", {
        "reporting_date": "reporting_date", "camp_id": "camp_id", "facebook_campaign_name": "campaign_name",
        "impressions": "impressions", "clicks": "clicks", "cost_euro": "cost_euro", "facebook_account_id": "account_id"}),
    "pinterest_pin_perf": ("fx_pinterest", {
        "reporting_date": "reporting_date", "camp_id": "camp_id", "pinterest_campaign_name": "campaign_name",
        "impressions_paid": "impressions", "clicks_paid": "clicks", "cost_euro": "cost_euro"}),
    "snap_ad_perf": ("fx_snap", {
        "reporting_date": "reporting_date", "camp_id": "camp_id", "snap_campaign_name": "campaign_name",
        "snap_account_name": "account_name", "impressions": "impressions", "cost_euro": "cost_euro"}),
    "tiktok_ad_perf": ("fx_tiktok", {
        "reporting_date": "reporting_date", "camp_id": "camp_id", "tiktok_campaign_name": "campaign_name",
        "tiktok_account_id": "account_id", "impressions": "impressions", "clicks": "clicks", "cost_euro": "cost_euro"}),
    "tv_flights": ("fx_actual", {
        "broadcast_date": "actual_date", "tv_flight_name": "campaign_name", "cost_euro_nnn": "cost_euro_nnn",
        "viewers_millions_e18p": "contacts"}),
    "bpn_planning": ("fx_plan", {
        "planning_date": "planning_date", "bpn_campaign_name": "campaign_name", "budget_origin": "budget_origin",
        "channel": "channel", "cost_euro_nnn_planned": "cost_euro_nnn_planned",
        "gross_contacts_planned": "gross_contacts_planned"}),
    "agency_fee": ("fx_fee", {
        "year_month": "year_month", "channel_branding": "channel_branding", "sub_channel_branding": "sub_channel_branding",
        "fee": "fee", "discount": "discount", "managed_fee": "managed_fee", "dsp_fee": "dsp_fee"}),
    "radio_marketer": ("fx_radio", {
        "reporting_start_date": "actual_date", "reporting_end_date": "end_date",
        "bpn_radio_campaign_name": "campaign_name", "cost_euro_nnn": "cost_euro_nnn", "contacts": "contacts"}),
    "radio_webradio": ("fx_webradio", {
        "reporting_date": "actual_date", "bpn_radio_campaign_name": "campaign_name",
        "cost_euro_nnn": "cost_euro_nnn", "impressions": "contacts"}),
    "digital_mediaplan": ("fx_mediaplan", {c: c for c in (
        "adgap_ids", "campaign_scope", "channel", "media_type", "media_billing_type", "media_creative_type", "client",
        "placement_start_cet", "placement_end_cet", "target_group_size", "daily_media_cost_nnn_euro")}),
    "bpn_adition_perf": ("fx_adition", {c: c for c in (
        "banner_external_id", "campaign_external_id", "reporting_date", "clicks", "impressions")}),
    "adgap_id_mapping": ("fx_adgap", {"adgap_id": "adgap_id", "adgap_ids": "adgap_ids"}),
    "dooh_perf": ("fx_dooh", {
        "planning_date": "planning_date", "jostvonbrandis_campaign_name": "campaign_name", "cost_type": "cost_type",
        "cost_euro_nn_without_bonus": "cost_euro_nn_without_bonus", "cost_euro_nnn": "cost_euro_nnn"}),
    "campaign_persist": ("fx_campaign_h", {"campaign_id": "campaign_id"}),
    "exchange_rates": ("fx_rate", {"reporting_date": "reporting_date", "exchange_rate_eur_to_usd": "exchange_rate_eur_to_usd"}),
    "print_plan": ("fx_print", {
        "initiative_name": "initiative_name", "project_name": "project_name", "pwm_shipping_type": "shipping_type",
        "pwm_season_financial_year": "season_year", "pwm_opp_wbkz": "opp_wbkz", "pwm_ppc_wbkz": "ppc_wbkz",
        "pwm_wbkz": "wbkz", "pwm_pages_total": "pages_total", "pwm_circulation_plan": "circulation_plan",
        "pwm_circulation_actual": "circulation_actual", "pwm_new_test": "is_test", "pwm_format_height": "height",
        "pwm_format_width": "width", "pwm_content_surface_weight": "content_weight",
        "pwm_content_number_pages": "content_pages", "pwm_cover_surface_weight": "cover_weight",
        "pwm_cover_number_pages": "cover_pages"}),
    "print_creation_cost": ("fx_print_cost", {"auftrag": "auftrag", "kostenartenbes": "kostenartenbes", "wert_overall": "wert_overall"}),
    "print_creative_cost": ("fx_creative_cost", {"auftrag": "auftrag", "kostenartenbes": "kostenartenbes", "wert_overall": "wert_overall"}),
    "print_shipping_cost": ("fx_shipping_cost", {"auftrag": "auftrag", "kostenartenbes": "kostenartenbes", "wert_overall": "wert_overall"}),
}


def _kind(type_: str) -> str:
    """Types that do for each other in a report: whole numbers and DECIMALs, and timestamps with and without zone."""
    return "number" if type_.startswith(("decimal", "tinyint", "smallint", "int", "bigint")) else \
        "timestamp" if type_.startswith("timestamp") else type_


def columns_of(name: str, df: DataFrame) -> list[str]:
    """The source's columns, and its partition day where the table has one."""
    day = contract.day_partition(name)
    have = {c.lower() for c in df.columns}
    return [*SOURCES[name][1], *([day] if day and day not in SOURCES[name][1] and day in have else [])]


def check_source(name: str, df: DataFrame) -> DataFrame:
    """The source's columns by name; raises if one is missing or of another kind than declared."""
    types = {c.lower(): t for c, t in df.dtypes}
    faults = []
    for column in SOURCES[name][1]:
        want, have = contract.declared(name, column), types.get(column)
        if have is None:
            faults.append(f"{column} is missing")
        elif _kind(have) != _kind(want) and not (want == "double" and _kind(have) == "number") \
                and not (column == "planning_date" and _kind(have) in ("date", "timestamp")):
            faults.append(f"{column} is {have}, not {want}")
    if faults:
        raise ValueError(f"source {name}: " + "; ".join(faults))
    return df.select(*columns_of(name, df))


class Catalog(Mapping):
    """Lazy, memoizing mapping from logical source name to DataFrame."""

    def __init__(self, spark: SparkSession, loader: Callable[[str], DataFrame], buckets: Mapping[str, int] | None = None):
        self.spark = spark
        self._loader = loader
        self._cache: dict[str, DataFrame] = {}
        self._buckets = buckets or {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in SOURCES:
            raise KeyError(name)
        if name not in self._cache:
            self._cache[name] = self._loader(name)
        return self._cache[name]

    def __iter__(self):
        return iter(SOURCES)

    def __len__(self):
        return len(SOURCES)

    def days(self, name: str, lo: dt.date, hi: dt.date | None = None) -> DataFrame:
        """The source without the day partitions outside [lo, hi], where it is stored by the day of a timestamp.

        Only leaves partitions out: the report still tests the days of single rows. Sources partitioned by a
        date column need no such cut, since the report's own test prunes them.
        """
        df = self[name]
        if contract.SOURCE_DAY not in df.columns:
            return df
        day = F.col(contract.SOURCE_DAY)
        return df.filter((day >= F.lit(lo)) if hi is None else day.between(F.lit(lo), F.lit(hi)))

    def colocated(self, *names: str) -> bool:
        """Whether these sources are bucketed by their join key into the same number of buckets."""
        return len({self._buckets.get(n) for n in names}) == 1 and self._buckets.get(names[0]) is not None


def reader_schema(name: str, types: Mapping[str, str] | None = None) -> str:
    """The source's columns with their declared types, as a DDL string; ``types`` replaces some."""
    return ", ".join(f"{c} {(types or {}).get(c) or contract.declared(name, c)}" for c in SOURCES[name][1])


def parquet_catalog(spark: SparkSession, root: str, types: Mapping[str, Mapping[str, str]] | None = None) -> Catalog:
    """Production layout: ``{root}/{logical name}`` parquet datasets, plain or in folders by day partition.

    Schemas are the declared ones (``types``: by source and column, where they differ), so nothing is read
    when a source is opened. For many day folders prefer tables (``sources.tables``): their folders
    are listed only as far as a report's days reach.
    """
    def load(name: str) -> DataFrame:
        schema = reader_schema(name, (types or {}).get(name))
        return check_source(name, spark.read.schema(schema).parquet(f"{root.rstrip('/')}/{name}"))

    return Catalog(spark, load)


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def binding_schema(binding: str) -> str:
    """Columns and declared types of a stored binding: what the sources on it read."""
    types = {}
    for name, (of, columns) in SOURCES.items():
        if of == binding:
            types |= {src: contract.declared(name, dst) for dst, src in columns.items()}
    return ", ".join(f"{c} {t}" for c, t in types.items())


def fixture_catalog(spark: SparkSession, sf_dir: str, materialize_dir: str | None = None) -> Catalog:
    """Sources derived from the TPC-H-like tables under ``sf_dir``.

    By default each binding is a lazy plan over the test tables (derived on every
    run). With ``materialize_dir`` (a shared folder, e.g. under the session's
    ``spark.checkpoint.dir``) each binding is written once as Parquet and read
    back, like the stored source tables the reports read in production.
    """
    base: dict[str, DataFrame] = {}
    fx: dict[str, DataFrame] = {}

    def derive(binding: str) -> DataFrame:
        if materialize_dir is None:
            return spark_binding(spark, binding, base_tables())
        path = f"{materialize_dir.rstrip('/')}/{binding}"
        if not _exists(spark, f"{path}/_SUCCESS"):
            # files of at most 100k rows, like a stored table: fact-sized sources
            # get several files (the test tables are single row-group files that
            # one task would otherwise scan alone), small dimensions stay one file
            spark_binding(spark, binding, base_tables()).write.mode("overwrite") \
                .option("maxRecordsPerFile", 100_000).parquet(path)
        return spark.read.schema(binding_schema(binding)).parquet(path)

    def base_tables():
        if not base:
            for t, schema in contract.BASE_TABLES.items():
                base[t] = spark.read.schema(schema).parquet(f"{sf_dir.rstrip('/')}/{t}.parquet")
        return base

    def load(name: str) -> DataFrame:
        binding, cols = SOURCES[name]
        if binding not in fx:
            fx[binding] = derive(binding)
        return fx[binding].select(*[F.col(src).alias(dst) for dst, src in cols.items()])

    return Catalog(spark, load)
