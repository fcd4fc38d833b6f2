import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from metroflux.session import build_session
    ckpt = tempfile.mkdtemp(prefix="metroflux-test-")
    s = build_session("local[4]", shuffle_partitions=8, app_name="metroflux-tests",
                      extra={"spark.checkpoint.dir": ckpt})
    yield s
    s.stop()


SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"
