import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from postlake.session import get_session, shared_dir
    s = get_session("local[4]", 8)
    shared_dir(s)
    yield s
    s.stop()
