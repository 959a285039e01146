import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from urbanlens.session import build_session
    s = build_session("local[4]", shuffle_partitions=8, app_name="urbanlens-tests")
    yield s
    from urbanlens.sources import scratch
    scratch.clear(s)
    s.stop()
