import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    root = tempfile.mkdtemp(prefix="waymark-test-")
    session = (
        SparkSession.builder.master("local[8]")
        .appName("waymark-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", f"{root}/warehouse")
        .config("spark.checkpoint.dir", f"{root}/shared")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


@pytest.fixture
def salting(spark):
    """Treat every table as large and salt every heavy key."""
    spark.conf.set("spark.waymark.skew.minBytes", "0")
    spark.conf.set("spark.waymark.skew.partRows", "20")
    yield
    spark.conf.unset("spark.waymark.skew.minBytes")
    spark.conf.unset("spark.waymark.skew.partRows")
