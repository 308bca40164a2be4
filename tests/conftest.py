import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(__file__), ".."))


def session():
    from pyspark.sql import SparkSession
    spark = (SparkSession.builder.master("local[8]").appName("tests")
             .config("spark.sql.shuffle.partitions", "4")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.driver.memory", "8g")
             .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-"))
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.python.sql.dataFrameDebugging.enabled", "false")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture(scope="session")
def spark():
    return session()
