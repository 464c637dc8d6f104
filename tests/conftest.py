import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from shelfwise.session import build_session
    s = build_session("local[4]", shuffle_partitions=4, app_name="shelfwise-tests")
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    from shelfwise.session import scratch_dir
    return lambda name="t": scratch_dir(spark, name)
