import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "/root/testdata/sf0.001"


# made at import: test modules build column expressions at their top level
SESSION = (
    SparkSession.builder.master("local[4]")
    .appName("labelgrain-tests")
    .config("spark.driver.memory", "6g")
    .config("spark.sql.shuffle.partitions", "4")
    .config("spark.sql.session.timeZone", "UTC")
    .config("spark.ui.enabled", "false")
    .config("spark.ui.showConsoleProgress", "false")
    .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="labelgrain-tests-"))
    .getOrCreate()
)
SESSION.sparkContext.setLogLevel("ERROR")


@pytest.fixture(scope="session")
def spark():
    yield SESSION
    SESSION.stop()


@pytest.fixture
def values(spark):
    """Evaluate one column expression over rows of a DataFrame, as a list."""

    def run(df, column):
        return [r[0] for r in df.select(column).collect()]

    return run


@pytest.fixture
def texts(spark):
    return lambda *items: spark.createDataFrame([(t,) for t in items], "t string")


@pytest.fixture
def conf(spark):
    """Set session options for one test."""
    saved = {}

    def put(key, value):
        saved.setdefault(key, spark.conf.get(key, None))
        spark.conf.set(key, value)

    yield put
    for key, value in saved.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)
