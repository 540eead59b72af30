import sys
import tempfile
from pathlib import Path

import pytest

REPO = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(REPO))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"
M = 60 * 1_000_000  # one minute in microseconds


@pytest.fixture(scope="session")
def spark():
    from lateflow.session import build_session

    s = build_session("local[4]", 4)
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="lateflow-test-", dir="/tmp")
