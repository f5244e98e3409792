import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from matchlake.session import get_session
    s = get_session("local[*]", app="matchlake-tests", shuffle_partitions=8,
                    extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="matchlake-test-ckpt-"),
                           "spark.driver.memory": "6g"})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return SF_SMALL
