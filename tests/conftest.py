import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from vaultmart.session import build_session, ensure_checkpoint_dir
    s = build_session("local[4]", shuffle_partitions=8, app="vaultmart-tests")
    ensure_checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture()
def workdir():
    return tempfile.mkdtemp(prefix="vaultmart-test-")
