import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tools"))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from spendlens.session import get_spark
    s = get_spark("local[4]", 4)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_small():
    return SMALL
