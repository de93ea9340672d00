import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tabletrust.session import build_session, ensure_checkpoint_dir

    s = build_session(app="tabletrust-tests", master="local[4]", shuffle_partitions=8)
    ensure_checkpoint_dir(s, tempfile.mkdtemp(prefix="tt-test-ckpt-", dir="/tmp"))
    yield s
    s.stop()
