import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from retentio.session import get_session
    s = get_session("local[2]", 4)
    if not s.sparkContext.getCheckpointDir():
        # tests only: the cluster names spark.checkpoint.dir
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="retentio-test-ckpt-"))
    yield s


@pytest.fixture(scope="session")
def sf():
    return SF_SMOKE
