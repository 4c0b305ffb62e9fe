import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from evidentia.session import get_session


@pytest.fixture(scope="session")
def spark():
    session = get_session("tests", "local[4]", 4)
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def values(spark):
    """Evaluate one column expression over several texts in one job."""

    def run(make, texts):
        from pyspark.sql import functions as F

        df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
        return [r.v for r in df.select("i", make(F.col("text")).alias("v")).orderBy("i").collect()]

    return run
