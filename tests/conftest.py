import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from lakesync.session import ensure_checkpoint_dir, local_session

    session = local_session(cores="*", shuffle_partitions=8, app_name="lakesync-tests")
    ensure_checkpoint_dir(session, lambda: tempfile.mkdtemp(prefix="lakesync-tests-ckpt-"))
    yield session
    session.stop()


@pytest.fixture()
def scratch(spark):
    from lakesync.session import scratch_path

    return lambda name: scratch_path(spark, name)
