import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from anchorwise.session import build_session

    s = build_session("local[4]", shuffle_partitions=8, app="anchorwise-tests")
    yield s


@pytest.fixture(scope="session")
def duck0001():
    from tests.oracle_compare import duck

    return duck(SF0001)
