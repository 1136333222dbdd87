import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from torque.session import get_session
    s = get_session("local[*]", 8, app="torque-tests")
    yield s
    s.stop()


def rows(df, order=None):
    """Collected rows as tuples, sorted for order-insensitive comparison."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
