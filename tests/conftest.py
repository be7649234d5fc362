import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from alloy.session import local_session

    s = local_session("*", shuffle_partitions=8, app="alloy-tests")
    yield s
    s.stop()


@pytest.fixture
def tmp_dir(spark):
    from alloy.session import scratch_path

    return scratch_path(spark, "test")
