"""What several test modules share; fixtures stay in conftest.py."""

#: The smallest test tables.
SF_SMALL = "/root/testdata/sf0.001"


def literal_catalog(spark, frames: dict):
    """A catalog over in-test DataFrames (edge cases the bindings cannot carry)."""
    from spendlens.sources.catalog import Catalog

    return Catalog(spark, lambda name: frames[name])
