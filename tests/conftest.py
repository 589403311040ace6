import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from zonecast.session import build_session

    s = build_session("local[*]", 8)
    # tests run where no cluster checkpoint folder is configured: use our own
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="zonecast-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="zonecast-test-")
