import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
DATA = os.path.join(ROOT, "tests", "data")


@pytest.fixture(scope="session")
def spark():
    from textgraph.session import local_session
    s = local_session(cpus="*", shuffle_partitions=2, app="textgraph-tests")
    yield s
    s.stop()


@pytest.fixture
def data():
    return lambda *p: os.path.join(DATA, *p)
