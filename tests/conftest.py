import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))


@pytest.fixture(scope="session")
def spark():
    from marketloom.session import local_session

    session = local_session(8, "tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """Evaluate a column function on literal rows of one column."""

    def evaluate(fn, values, dtype="string"):
        from pyspark.sql import functions as F

        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {dtype}")
        return [r.y for r in df.select("i", fn(F.col("x")).alias("y")).orderBy("i").collect()]

    return evaluate
