from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from stagewise.session import build_session

    s = build_session("local[*]", app_name="stagewise-tests", shuffle_partitions=8)
    # Tests run locally: give the session its own checkpoint folder (a cluster
    # names a shared one in spark.checkpoint.dir).
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="stagewise-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture
def tmp_dir():
    return tempfile.mkdtemp(prefix="stagewise-test-")


@pytest.fixture(scope="session")
def sf_small():
    if not os.path.exists(SF_SMALL):
        pytest.skip("test tables not available")
    return SF_SMALL
