import os
import sys
import tempfile

import pytest

# the repository, and the tests' own helpers (support.py), from whatever folder pytest runs
HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(HERE), HERE]


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (SparkSession.builder.master("local[*]")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="spendlens-warehouse-"))
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.driver.memory", "8g")
         .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="spendlens-tests-"))
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture(scope="session")
def cfg():
    from spendlens.config import testing

    return testing()
