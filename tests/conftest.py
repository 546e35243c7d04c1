import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from prepwise.session import local_session
    s = local_session(cores="*", shuffle_partitions=8)
    yield s


@pytest.fixture
def frame(spark):
    """Build a DataFrame with a row id from rows and a DDL schema."""
    from pyspark.sql import functions as F

    from prepwise.context import ROW_ID

    def make(rows, schema, row_id=True):
        df = spark.createDataFrame(rows, schema)
        if row_id:
            df = df.withColumn(ROW_ID, F.monotonically_increasing_id())
        return df
    return make
