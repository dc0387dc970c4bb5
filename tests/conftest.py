import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sluice.session import get_session  # noqa: E402

FIXTURES = os.path.join(os.path.dirname(os.path.abspath(__file__)), "fixtures")
SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[4]", app_name="sluice-tests", shuffle_partitions=4)
    yield s


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="sluice-test-")
