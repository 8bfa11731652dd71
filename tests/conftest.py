import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from voltmart.session import build_session
    s = build_session("local[*]", 8, app_name="voltmart-tests")
    yield s
    s.stop()


@pytest.fixture
def tmp(tmp_path):
    return str(tmp_path)


@pytest.fixture(scope="session")
def scratch():
    return tempfile.mkdtemp(prefix="voltmart-test-")
