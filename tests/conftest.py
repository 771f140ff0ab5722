import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from arrivalgate.session import build_session
    s = build_session("local[*]", 8, app_name="arrivalgate-tests")
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    """A fresh scratch folder per test (never reused, never cleared)."""
    return tempfile.mkdtemp(prefix="arrivalgate-test-")
