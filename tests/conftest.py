import pathlib
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path[:0] = [str(pathlib.Path(__file__).parents[1])]

SMALL = "/root/testdata/sf0.001"


def make_session() -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]")
        .appName("balcao-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        # Short tests spend more on compiling well than they gain from it.
        .config("spark.driver.extraJavaOptions", "-XX:TieredStopAtLevel=1 -XX:ReservedCodeCacheSize=512m")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="balcao-tests-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture(scope="session")
def spark():
    session = make_session()
    yield session
    session.stop()


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="balcao-tests-")
