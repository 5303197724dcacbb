import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import local_session
    s = local_session("*", 8, app="tidemark-tests", scratch=tempfile.mkdtemp(prefix="tm-test-"))
    yield s
    s.stop()
