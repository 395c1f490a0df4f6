import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("prepflow-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def people(spark):
    rows = [(1, "Ann", 10.0, "Oslo"), (2, "bob", None, "Rome"), (3, "Cat", 30.0, None), (4, None, 40.0, "oslo")]
    return spark.createDataFrame(rows, "id bigint, name string, pay double, city string")


def bag(df, *columns):
    """Rows as a sorted list of tuples, nulls first."""
    rows = (df.select(*columns) if columns else df).collect()
    return sorted((tuple(r) for r in rows), key=lambda r: [(x is not None, str(type(x)), x) for x in r])
