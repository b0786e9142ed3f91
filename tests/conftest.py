import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from drawloom.session import local_session

    s = local_session(int(os.environ.get("TEST_CPUS", "4")), shuffle_partitions=4)
    yield s
    s.stop()
