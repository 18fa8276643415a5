import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from deltaq.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, shuffle_partitions=4, app="deltaq-tests")
    yield s
    s.stop()


@pytest.fixture
def scratch():
    """A fresh scratch folder per test (never reused or cleared)."""
    return tempfile.mkdtemp(prefix="deltaq-test-")
