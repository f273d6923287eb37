"""UNION ALL of report branches by column name."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def union_all(frames: list[DataFrame]) -> DataFrame:
    """UNION ALL by name; branches are built to one schema (constants cast explicitly)."""
    return reduce(lambda a, b: a.unionByName(b), frames)
