from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from townvoice.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    spark = session("tests", 4, **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g"})
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture
def column(spark):
    """Apply a column function to Python values: ``column(f, [...], "string")``."""

    def apply(function, values, kind="string"):
        from pyspark.sql import functions as F

        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
        return [row.y for row in df.select("i", function(F.col("x")).alias("y")).orderBy("i").collect()]

    return apply
