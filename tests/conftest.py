import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def ratings(spark):
    from rankwell.sources.tables import ratings_view

    return ratings_view(spark, SMALL).persist()


@pytest.fixture(scope="session")
def movies(spark):
    from rankwell.sources.tables import movies_view

    return movies_view(spark, SMALL).persist()


@pytest.fixture(scope="session")
def skewed(spark):
    """User 1 holds a third of all rows, item 1 nearly every user; (userId, movieId, rating)."""
    rows = {(1, i): (i % 10 + 1) / 2 for i in range(1, 61)}
    rows |= {(u, 1): (u % 7 + 1) / 2 for u in range(1, 31)}
    rows |= {(u, (u * 7 + j * 11) % 60 + 1): ((u + j) % 9 + 1) / 2 for u in range(2, 31) for j in range(4)}
    return spark.createDataFrame(
        [(u, i, r) for (u, i), r in rows.items()], "userId long, movieId long, rating double"
    ).persist()


def rows_of(df, *order):
    """Rows as sorted tuples, floats to nine places."""
    return sorted(
        tuple(round(v, 9) if isinstance(v, float) else v for v in row) for row in (df.select(*order) if order else df).collect()
    )
