"""Digital media plan: booked days, delivered volume, effective cost by billing type."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fv
from .fees import month_key
from .spread import running_days

PLACEMENT_KEYS = ("adgap_ids", "campaign_scope", "channel", "media_type", "media_billing_type",
                  "media_creative_type", "client", "placement_duration")


def recode_channel(c: Column) -> Column:
    expr = None
    for src, dst in fv.DIGITAL_CHANNEL_RECODE:
        expr = F.when(c == src, F.lit(dst)) if expr is None else expr.when(c == src, F.lit(dst))
    return expr.otherwise(c)


def recode_media_type(c: Column) -> Column:
    u = F.upper(c)
    expr = None
    for src, dst in fv.DIGITAL_MEDIA_TYPE_RECODE:
        expr = F.when(u == src, F.lit(dst)) if expr is None else expr.when(u == src, F.lit(dst))
    return expr.otherwise(F.lit(fv.DIGITAL_MEDIA_TYPE_OTHER))


def placements(plan: DataFrame) -> DataFrame:
    """Media-plan rows in scope, recoded; NULL creative types drop out (NOT IN)."""
    return (
        plan.filter(F.upper(F.col("campaign_scope")).isin(list(fv.DIGITAL_SCOPES)))
        .filter(~F.upper(F.col("media_type")).isin([fv.DIGITAL_EXCLUDED_MEDIA_TYPE]))
        .filter(~F.upper(F.col("media_creative_type")).isin([fv.DIGITAL_EXCLUDED_CREATIVE_TYPE]))
        .withColumn("channel", recode_channel(F.col("channel")))
        .withColumn("media_type", recode_media_type(F.col("media_type")))
        .withColumn("placement_duration",
                    (F.datediff(F.col("placement_end_cet"), F.col("placement_start_cet")) + 1).cast("int"))
    )


def booked_days(plan: DataFrame, lo: dt.date, hi: dt.date) -> DataFrame:
    """Booked volume and cost per placement day: SUM / duration, over [lo, hi].

    The reference cross-joins the calendar and keeps days inside the placement; here a placement
    enters as two changes and the days come from running sums (no nested-loop join, no row per day).
    """
    days = running_days(placements(plan), list(PLACEMENT_KEYS), "placement_start_cet", "placement_end_cet", lo, hi,
                        {"_tgs": F.col("target_group_size"), "_cost": F.col("daily_media_cost_nnn_euro")}, out="datum")
    dur = F.nullif(F.col("placement_duration"), F.lit(0)).cast("double")
    return days.select("datum", *PLACEMENT_KEYS,
                       (F.col("_tgs").cast("double") / dur).alias("buchungsvolumen"),
                       (F.col("_cost").cast("double") / dur).alias("kosten_nnn"),
                       F.lit(0).cast("bigint").alias("clicks"), F.lit(0).cast("bigint").alias("impressions"))


LEVEL4_KEYS = ("adgap_ids", "campaign_scope", "channel", "media_type", "media_billing_type")


def delivery_rows(delivery: DataFrame, adgap_map: DataFrame, lo: dt.date, hi: dt.date) -> DataFrame:
    """Delivered clicks and impressions per ad-gap id and day, in the id groups of the id."""
    ad = (delivery.filter(F.col("reporting_date").between(F.lit(lo), F.lit(hi)))
          .groupBy(F.coalesce(F.col("banner_external_id"), F.col("campaign_external_id")).alias("adgap_id"),
                   F.col("reporting_date").alias("datum"))
          .agg(F.sum("clicks").alias("clicks"), F.sum("impressions").alias("impressions")))
    return (ad.join(adgap_map.select("adgap_id", "adgap_ids"), "adgap_id", "inner")
            .select("adgap_ids", "datum", "clicks", "impressions"))


def delivery_per_group(delivery: DataFrame, adgap_map: DataFrame, lo: dt.date, hi: dt.date) -> DataFrame:
    """Delivered clicks and impressions per (ad-gap id group, day).

    The fact is aggregated per (ad-gap id, day) first (map-side partial sums),
    then mapped to its id groups through the (small) mapping and summed again.
    """
    return (delivery_rows(delivery, adgap_map, lo, hi).groupBy("adgap_ids", "datum")
            .agg(F.sum("clicks").alias("clicks"), F.sum("impressions").alias("impressions")))


def _times_placements(per_group: DataFrame, plan: DataFrame) -> DataFrame:
    """Repeat each group's delivery once per matching placement, as a multiplier.

    As written, every delivery row joins every placement sharing its id group
    (without a date check) and is summed per placement attributes, so it counts
    once per matching placement. The placements are counted per attribute set
    (a dimension aggregate) and the sums multiplied: the
    fact side never fans out.
    """
    attrs = placements(plan).groupBy(*PLACEMENT_KEYS).agg(F.count(F.lit(1)).cast("bigint").alias("_n"))
    j = per_group.join(attrs, "adgap_ids", "inner")
    return j.select(
        "datum", *PLACEMENT_KEYS,
        F.lit(0.0).alias("buchungsvolumen"), F.lit(0.0).alias("kosten_nnn"),
        (F.col("clicks") * F.col("_n")).alias("clicks"), (F.col("impressions") * F.col("_n")).alias("impressions"),
    )


def delivered_days(delivery: DataFrame, adgap_map: DataFrame, plan: DataFrame, lo: dt.date, hi: dt.date) -> DataFrame:
    """The delivered leg at its written grain: per placement attributes and day."""
    return _times_placements(delivery_per_group(delivery, adgap_map, lo, hi), plan)


def effective_cost(kosten: Column, volume: Column, impressions: Column, clicks: Column, billing: Column) -> Column:
    """Billing-type cost: CPM/vCPM unit price x impressions, CPC x clicks, else booked; NULL -> 0.

    The unit price is cost / booked volume (not per mille), zero volume gives NULL.
    """
    unit = kosten / F.nullif(volume, F.lit(0.0))
    return F.coalesce(
        F.when(billing == fv.BILLING_CPM, unit * impressions)
        .when(billing == fv.BILLING_VCPM, unit * impressions)
        .when(billing == fv.BILLING_CPC, unit * clicks)
        .otherwise(kosten),
        F.lit(0.0),
    )


#: Attributes of a fee level row within its (id group, scope, channel).
FEE_ATTRIBUTES = ("media_type", "media_billing_type")


def _total(rows: Column, field: str, type_: str) -> Column:
    """SUM of a field of array elements: NULLs are skipped, NULL if there is nothing else."""
    return F.aggregate(rows, F.lit(None).cast(type_), lambda total, r: F.coalesce(total + r[field], total, r[field]))


def digital_level3(delivery: DataFrame, adgap_map: DataFrame, plan: DataFrame, fees: DataFrame,
                   lo: dt.date, hi: dt.date) -> DataFrame:
    """Both legs with the month's fee per (day, scope, id group, channel): booked and effective cost, volumes, largest fee.

    As written, both legs are summed per (id group, day, LEVEL4_KEYS), where the fee joins (by month and media
    type) and the effective cost is taken, and summed again without billing and media type. A group's delivery
    counts once per matching placement (without a date check), so that level has a row per group, day and
    attribute set of the group's placements. These rows are not shuffled or held: a group's day is one row with
    its booked sums, the group's attribute sets (a dimension) join it, and the level's rows are made, joined
    with their fee and summed within it. The work per row grows with the group's attribute sets only.

    ``fees`` has fee_month, sub_channel_branding (upper case), fee and _fees, the number of rows it stands for.
    """
    booked = booked_days(plan, lo, hi).groupBy("datum", *LEVEL4_KEYS).agg(
        F.sum("buchungsvolumen").alias("volume"), F.sum("kosten_nnn").alias("cost"))
    entry = F.struct(*LEVEL4_KEYS[1:], "volume", "cost")
    days = (booked.select("adgap_ids", "datum", entry.alias("_entry"), F.lit(None).cast("bigint").alias("clicks"),
                          F.lit(None).cast("bigint").alias("impressions"), F.lit(False).alias("_delivered"))
            .unionByName(delivery_rows(delivery, adgap_map, lo, hi).filter(F.col("adgap_ids").isNotNull())
                         .withColumn("_delivered", F.lit(True)), allowMissingColumns=True)
            .groupBy("adgap_ids", "datum")
            .agg(F.sum("clicks").alias("_clicks"), F.sum("impressions").alias("_impressions"),
                 F.max("_delivered").alias("_delivered"), F.collect_list("_entry").alias("_booked")))
    sets = placements(plan).groupBy(*LEVEL4_KEYS).agg(F.count(F.lit(1)).cast("bigint").alias("n"))
    sets = (sets.groupBy("adgap_ids", "campaign_scope", "channel")
            .agg(F.collect_list(F.struct(*FEE_ATTRIBUTES, "n")).alias("sets"))
            .groupBy(F.col("adgap_ids").alias("_group"))
            .agg(F.collect_list(F.struct("campaign_scope", "channel", "sets")).alias("_scopes")))
    monthly = (fees.filter(F.col("sub_channel_branding").isNotNull()).groupBy("fee_month")
               .agg(F.map_from_entries(F.collect_list(F.struct("sub_channel_branding", F.struct("fee", "_fees")))).alias("_month_fees")))
    rows = (days.join(sets, F.col("adgap_ids").eqNullSafe(F.col("_group"))).withColumn("_scope", F.explode("_scopes"))
            .join(monthly, month_key(F.col("datum")) == F.col("fee_month"), "left"))

    def level4(s: Column) -> Column:
        """The row of one attribute set."""
        same = F.filter("_booked", lambda e: (e["campaign_scope"].eqNullSafe(F.col("_scope.campaign_scope")))
                        & (e["channel"].eqNullSafe(F.col("_scope.channel")))
                        & (e["media_type"].eqNullSafe(s["media_type"]))
                        & (e["media_billing_type"].eqNullSafe(s["media_billing_type"])))
        return F.struct(s["media_type"].alias("media_type"), s["media_billing_type"].alias("billing"), s["n"].alias("n"),
                        F.get(same, F.lit(0)).alias("booked"), F.col("_month_fees")[s["media_type"]].alias("fee"))

    def with_sums(r: Column) -> Column:
        def either(c: Column, none: Column) -> Column:
            return F.coalesce(c, none)

        times = either(r["fee"]["_fees"], F.lit(1))
        zero = F.when(F.col("_delivered"), F.lit(0.0))  # a delivery has no cost and no booked volume
        none = F.when(r["booked"].isNotNull(), F.lit(0).cast("bigint"))  # a booking has no clicks
        return F.struct(
            (either(r["booked"]["cost"], zero) * times).alias("cost"), (either(r["booked"]["volume"], zero) * times).alias("volume"),
            (either(F.col("_clicks") * r["n"], none) * times).alias("clicks"),
            (either(F.col("_impressions") * r["n"], none) * times).alias("impressions"),
            r["billing"].alias("billing"), r["fee"]["fee"].alias("fee"))

    there = F.filter(F.transform("_scope.sets", level4), lambda r: F.col("_delivered") | r["booked"].isNotNull())
    rows = rows.withColumn("_rows", F.transform(there, with_sums)).filter(F.size("_rows") > 0)
    effective = F.aggregate("_rows", F.lit(0.0), lambda total, r: total + effective_cost(
        r["cost"], r["volume"], r["impressions"], r["clicks"], r["billing"]))
    return rows.select(
        "datum", F.col("_scope.campaign_scope").alias("campaign_scope"), "adgap_ids", F.col("_scope.channel").alias("channel"),
        _total(F.col("_rows"), "cost", "double").alias("kosten_nnn"), _total(F.col("_rows"), "clicks", "bigint").alias("clicks"),
        effective.alias("kosten_nnn_eff"), F.array_max(F.transform("_rows", lambda r: r["fee"])).alias("fee"),
        _total(F.col("_rows"), "impressions", "bigint").alias("impressions"))
