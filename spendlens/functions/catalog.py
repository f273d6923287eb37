"""Catalogue (print) helpers: project-name clean-up, season, weight, id."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed_values as fv


def project_name_corr(name: Column) -> Column:
    """``NNGJ_<project>_...`` -> ``<project>``; other names unchanged.

    The match test is a full match (``\\z`` anchors the end, ``.`` stops at a
    newline); the replacement's group reference is ``$1`` in Java regex.
    """
    matches = name.rlike(fv.CATALOG_PROJECT_MATCH + r"\z")
    return F.when(matches, F.regexp_replace(name, fv.CATALOG_PROJECT_PATTERN, "$1")).otherwise(name)


def season(season_fy: Column) -> Column:
    """Two leading digits of the financial year as DECIMAL(18,0); NULL without them."""
    return F.regexp_substr(season_fy, F.lit(fv.CATALOG_SEASON_RE)).cast("decimal(18,0)")


def catalog_weight(shipping_type: Column, h: Column, w: Column, content_weight: Column, content_pages: Column,
                   cover_weight: Column, cover_pages: Column) -> Column:
    """Area x (content weight x pages + cover weight x pages) / 2 x 1.04, +5 for packages.

    NULL if any factor is NULL. The +5 test is case-sensitive on the raw type.
    """
    area = (h / 100) * (w / 100)
    paper = content_weight * content_pages + cover_weight * cover_pages
    base = area * paper / 2 * F.lit(float(fv.CATALOG_WEIGHT_FACTOR))
    return F.when(shipping_type == fv.CATALOG_PACKAGE, base + fv.CATALOG_PACKAGE_EXTRA).otherwise(base)


def catalog_id(project_corr: Column, season_col: Column, shipping_lower: Column) -> Column:
    """Helper id of a catalogue project: MD5 over project, season and shipping type.

    The source system's byte layout of its MD5 input is not known, so this is an id of
    our own: each value as 'v' and its text, NULL as 'n', joined by '|'.
    """
    parts = [F.coalesce(F.concat(F.lit("v"), c.cast("string")), F.lit("n"))
             for c in (project_corr, season_col, shipping_lower)]
    return F.md5(F.concat_ws("|", *parts))
