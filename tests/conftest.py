import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from coview.session import get_session  # noqa: E402

DATA = os.path.join(os.path.dirname(os.path.abspath(__file__)), "data")
SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[4]", 8, app_name="coview-tests")
    # Tests run without a cluster: only here do we pick the checkpoint folder.
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="coview-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture
def scratch(spark):
    from coview.session import scratch_path
    return lambda name: scratch_path(spark, name)
