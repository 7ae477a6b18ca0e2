from __future__ import annotations

import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from mailloom.session import configure  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


def make_session() -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]")
        .appName("mailloom-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        # Call sites are not recorded for every column: plans build faster.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="mailloom-tests-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


@pytest.fixture(scope="session")
def spark():
    session = make_session()
    yield session
    session.stop()
