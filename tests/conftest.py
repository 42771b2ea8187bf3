import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    from seqloom.catalog.spark_queries import ship_package

    ship_package(session)
    yield session
    session.stop()


@pytest.fixture
def stream(spark):
    """A token list as a numbered stream."""

    def build(tokens, parts=3):
        rows = spark.createDataFrame(list(enumerate(tokens)), "idx bigint, token_id int")
        return rows.repartition(parts)

    return build


@pytest.fixture
def vectors(spark):
    def build(table):
        return spark.createDataFrame(list(table.items()), "token_id int, vec array<float>")

    return build
