import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from countwise.session import local_session

    return local_session("*", shuffle_partitions=8, app="countwise-tests")


def edges_df(spark, pairs):
    return spark.createDataFrame([(int(u), int(v)) for u, v in pairs], "u BIGINT, v BIGINT")


def items_df(spark, values):
    return spark.createDataFrame([(int(x),) for x in values], "item BIGINT")
