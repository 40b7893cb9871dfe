import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from millrace.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "millrace-tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """Evaluate a function of one string on a list of strings."""
    from pyspark.sql import functions as F

    def run(function, texts, *others):
        rows = [(i, t, *[o[i] for o in others]) for i, t in enumerate(texts)]
        names = ["i", "t", *[f"o{k}" for k in range(len(others))]]
        df = spark.createDataFrame(rows, "i int, t string" + "".join(f", o{k} string" for k in range(len(others))))
        result = df.select("i", function(*names[1:]).alias("r")).orderBy("i")
        return [row["r"] for row in result.collect()]

    return run
