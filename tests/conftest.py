import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from widelines.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="widelines-test-", dir="/tmp")
    session = build_session(master="local[4]", shuffle_partitions=4,
                            extra={"spark.checkpoint.dir": f"{ckpt}/ckpt"})
    yield session
    session.stop()


@pytest.fixture()
def scratch(spark):
    from widelines.session import scratch_path
    return scratch_path(spark, "test")
