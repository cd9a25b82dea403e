import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    builder = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="vocatio-shared-"))
    )
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="vocatio-test-")


@pytest.fixture(scope="session")
def ask(spark):
    """Evaluate a text rule on a list of texts, in order."""
    from pyspark.sql import functions as F

    def run(rule, texts):
        rows = list(enumerate(texts))
        df = spark.createDataFrame(rows, "i int, t string").repartition(3)
        found = df.select("i", rule(F.col("t")).alias("r")).collect()
        return [row["r"] for row in sorted(found, key=lambda row: row["i"])]

    return run
