import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tillflow.session import build_session
    s = build_session(master="local[*]", shuffle_partitions=8, app_name="tillflow-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def star_small(spark):
    from tillflow.plans import warehouse
    return warehouse.star(spark, SF_SMALL)
