import os
import tempfile
import time

import pytest
from pyspark.sql import SparkSession

# Collected timestamps come back in the process's zone.
os.environ["TZ"] = "Asia/Ho_Chi_Minh"
time.tzset()

DATA = os.environ.get("TILLFLOW_TEST_DATA", "/root/testdata")


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "Asia/Ho_Chi_Minh")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tillflow-test-"))
        .config("spark.driver.memory", "6g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small_limits():
    """Limits so low that tiny groups are cut, salted and put together again."""
    from tillflow.options import GroupLimits

    return GroupLimits(max_rows=4)
