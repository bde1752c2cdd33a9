import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from lograft.session import get_session
    s = get_session("local[4]", app="lograft-tests", shuffle_partitions=4,
                    extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="lograft-test-ckpt-")})
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    from lograft.session import scratch_path
    return lambda name: scratch_path(spark, name)
