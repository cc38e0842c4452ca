import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (SparkSession.builder.master("local[4]").appName("kinrank-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.driver.memory", "8g")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


GOLDEN = [  # user, item, rating (FIXTURES.md golden micro-fixture)
    (1, 1, 5.0), (1, 2, 3.0), (1, 3, 1.0),
    (2, 1, 4.0), (2, 2, 2.0), (2, 3, 1.0), (2, 4, 5.0),
    (3, 1, 1.0), (3, 2, 3.0), (3, 3, 5.0), (3, 4, 2.0),
    (4, 1, 3.0), (4, 2, 3.0),
    (5, 5, 4.0),
]


@pytest.fixture(scope="session")
def golden(spark):
    return spark.createDataFrame(GOLDEN, "user_id bigint, item_id bigint, rating double")
