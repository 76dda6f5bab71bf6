import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from stratum.session import build_session
    s = build_session(master="local[8]", shuffle_partitions=8)
    yield s
    s.stop()


SF_SMALL = "/root/testdata/sf0.001"
