import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.join(os.path.dirname(__file__), ".."))
sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "tools"))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]").appName("stratamart-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session


@pytest.fixture
def no_broadcast(spark):
    """Run with the broadcast threshold at zero, so that joins take their large-input form."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


@pytest.fixture
def small_inputs_skew(spark):
    """Treat inputs of any size as large enough to be skewed."""
    name = "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "0")
    yield
    spark.conf.set(name, before)


def rows(df, *order):
    """Rows as sorted tuples, NULLs first."""
    data = [tuple(r) for r in df.collect()]
    return sorted(data, key=lambda r: tuple((v is not None, str(v)) for v in r))
