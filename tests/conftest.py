import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from opslake.session import checkpoint_dir, get_session
    s = get_session("local[4]", app="opslake-tests", shuffle_partitions=4)
    checkpoint_dir(s)  # tests only: a scratch checkpoint folder when none is configured
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_fresh():
    return tempfile.mkdtemp(prefix="opslake-test-")
