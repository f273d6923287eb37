"""Budget classification of campaigns (budget logic and budget share).

The budget logic is coded into the campaign id (markers such as ``-TW.BC-``) or,
for branding sources, into campaign names and plan attributes. Everything here is
a plain column expression, so it stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed_values as fv
from .text import has


def budget_logic(camp: Column) -> Column:
    """2 for TW/PF budget codes, 3 for W/F/SS.AG+D.C/SES codes, else 1 (also NULL)."""
    return (
        F.when(has(camp, fv.MARK_TW) | has(camp, fv.MARK_PF), 2)
        .when(has(camp, fv.MARK_W) | has(camp, fv.MARK_F)
              | (has(camp, fv.MARK_SS_AG) & has(camp, fv.MARK_D_C)) | has(camp, fv.MARK_SES), 3)
        .otherwise(1)
        .cast("int")
    )


def budget_logic_reduced(camp: Column) -> Column:
    """Variant without the PF and F markers (in-house display)."""
    return (
        F.when(has(camp, fv.MARK_TW), 2)
        .when(has(camp, fv.MARK_W) | (has(camp, fv.MARK_SS_AG) & has(camp, fv.MARK_D_C))
              | has(camp, fv.MARK_SES), 3)
        .otherwise(1)
        .cast("int")
    )


def _percent(camp: Column, pattern: str) -> Column:
    """Digits before ``.WS``/``.FS``: first regex match, then its digits; NULL if none."""
    first = F.regexp_substr(camp, F.lit(pattern))
    return F.regexp_substr(first, F.lit(fv.DIGITS_RE)).cast("double")


def budget_share(camp: Column, logic: Column, with_fs: bool = True) -> Column:
    """1 for logic 1, 0 for logic 3, else 1 - pct/100 from ``NN.WS`` (then ``NN.FS``)."""
    expr = (
        F.when(logic == 1, F.lit(1.0))
        .when(logic == 3, F.lit(0.0))
        .when(has(camp, fv.SHARE_WS_MARK), 1 - _percent(camp, fv.SHARE_WS_RE) / 100)
    )
    if with_fs:
        expr = expr.when(has(camp, fv.SHARE_FS_MARK), 1 - _percent(camp, fv.SHARE_FS_RE) / 100)
    return expr.cast("double")


def budget_share_ws(camp: Column, logic: Column) -> Column:
    """Branding variant: no ``.FS`` arm, an F-share campaign gets NULL."""
    return budget_share(camp, logic, with_fs=False)


def share_from_class(logic: Column) -> Column:
    """1 -> 1, 3 -> 0, else NULL."""
    return F.when(logic == 1, F.lit(1.0)).when(logic == 3, F.lit(0.0)).cast("double")


def logic_from_name(name: Column) -> Column:
    """3 if the campaign name carries ``_WKZ_``, else 1."""
    return F.when(has(name, fv.NAME_WKZ), 3).otherwise(1).cast("int")


def type_from_name(name: Column, marker: str = fv.NAME_VERTRIEB) -> Column:
    return F.when(has(name, marker), F.lit(fv.TYPE_VERTRIEB)).otherwise(F.lit(fv.TYPE_BRANDING))


def logic_from_origin(origin: Column) -> Column:
    """3 if the plan's budget origin is WKZ (any case), else 1."""
    return F.when(F.upper(origin) == fv.ORIGIN_WKZ, 3).otherwise(1).cast("int")


def type_from_origin(origin: Column) -> Column:
    return F.when(F.upper(origin) == fv.ORIGIN_VERTRIEB, F.lit(fv.TYPE_VERTRIEB)).otherwise(F.lit(fv.TYPE_BRANDING))


def with_budget(df, camp_col: str = "camp_id"):
    """Append ``budget_logic`` and ``budget_logic_share`` for a channel view.

    Rows that carry the classes of the campaign dimension take those; only campaigns that the
    dimension doesn't know are classified here.
    """
    camp = F.col(camp_col)
    if "campaign_logic" not in df.columns:
        return df.withColumn("budget_logic", budget_logic(camp)).withColumn(
            "budget_logic_share", budget_share(camp, F.col("budget_logic")))
    known = F.col("campaign_logic").isNotNull()
    own = budget_logic(camp)
    return df.withColumn("budget_logic", F.when(known, F.col("campaign_logic")).otherwise(own)).withColumn(
        "budget_logic_share", F.when(known, F.col("campaign_share")).otherwise(budget_share(camp, F.col("budget_logic"))))
