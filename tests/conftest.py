import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from sitegauge.session import build_session
    scratch = tempfile.mkdtemp(prefix="sitegauge-tests-")
    s = build_session(master="local[4]", shuffle_partitions=4, app="tests",
                      extra={"spark.checkpoint.dir": f"{scratch}/ckpt",
                             "spark.local.dir": f"{scratch}/local"})
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="sitegauge-case-")
