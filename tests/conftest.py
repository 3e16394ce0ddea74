import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from rowtide.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, "rowtide-tests", memory="4g")
    s.sparkContext.setLogLevel("ERROR")
    return s


SF = os.environ.get("ROWTIDE_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def sf():
    return SF
