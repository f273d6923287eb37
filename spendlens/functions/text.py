"""Substring tests in the reference's INSTR form, as Spark column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def has(col: Column, marker: str) -> Column:
    """INSTR(col, marker) > 0; NULL when col is NULL (three-valued, as INSTR)."""
    return F.instr(col, marker) > 0


def lacks(col: Column, marker: str) -> Column:
    """INSTR(col, marker) = 0; NULL when col is NULL."""
    return F.instr(col, marker) == 0


def has_upper(col: Column, marker: str) -> Column:
    return has(F.upper(col), marker)
