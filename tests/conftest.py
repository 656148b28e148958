import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from lotgate.session import local_session

    s = local_session(4, shuffle_partitions=8)
    yield s


SUB_COLS = ["Batch Name", "Manufacturer", "DoM", "Process", "Unit Operation", "Parameter", "Value"]


def frame(spark, rows, cols=SUB_COLS, extra=None):
    """A submission frame of text columns from literal tuples."""
    from pyspark.sql import types as T

    names = list(cols) + (list(extra) if extra else [])
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in names])
    return spark.createDataFrame([tuple(r) for r in rows], schema)
