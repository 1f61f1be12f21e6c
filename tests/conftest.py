import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cellforge.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", app="cellforge-tests", conf={"spark.sql.shuffle.partitions": "8"})
    yield s
    s.stop()


def lines_df(spark, lines):
    return spark.createDataFrame([(x,) for x in lines], "line string")


def cells_df(spark, rows):
    return spark.createDataFrame(rows, "row string, family string, qualifier string, ts bigint, value string")
