import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tillroll.session import build_session, drop_temporary
    s = build_session("local[8]", app="tillroll-tests", shuffle_partitions=8)
    yield s
    drop_temporary(s)  # while the session can still delete files
    s.stop()
