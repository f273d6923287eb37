"""Agency fee lookup by month and channel (and sub channel)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def month_key(d: Column) -> Column:
    """``TO_CHAR(d, 'yyyymm')`` as a number: year * 100 + month."""
    return (F.year(d) * 100 + F.month(d)).cast("int")


def fee_rows(fee: DataFrame, channel: str, case_fold: bool) -> DataFrame:
    """Fee rows of one branding channel with their numeric month key.

    The channel literal is filtered on the (small) fee table before the join;
    ``case_fold`` compares on UPPER(channel) as most branches do.
    """
    ch = F.upper(F.col("channel_branding")) if case_fold else F.col("channel_branding")
    return fee.filter(ch == channel).withColumn(
        "fee_month", F.col("year_month").cast("decimal(6,0)").cast("int"))


def join_fee(df: DataFrame, date_col: str, fees: DataFrame, sub_channel: Column | None = None,
             cols=("fee",)) -> DataFrame:
    """LEFT JOIN on the month (and upper-cased sub channel); fee rows fan out as written."""
    f = fees.select("fee_month", F.upper(F.col("sub_channel_branding")).alias("_fee_sub"), *cols)
    left = df.withColumn("_month", month_key(F.col(date_col)))
    cond = left["_month"] == f["fee_month"]
    if sub_channel is not None:
        left = left.withColumn("_sub", sub_channel)
        cond = cond & (left["_sub"] == f["_fee_sub"])
    out = left.join(f, cond, "left").drop("_month", "fee_month", "_fee_sub")
    return out.drop("_sub") if sub_channel is not None else out
