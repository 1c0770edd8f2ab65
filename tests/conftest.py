import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tally.session import get_session

    s = get_session("local[4]", app_name="tally-tests", conf={"spark.sql.shuffle.partitions": "8",
                                                                 "spark.sql.maxMetadataStringLength": "1000"})
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture(scope="session")
def duck_small():
    from tests.oracle_compare import duck

    return duck(SF_SMALL)


def rows(df):
    return [r.asDict(recursive=True) for r in df.collect()]
