import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from matchlake.session import get_session
    s = get_session("local[4]", app="matchlake-tests", shuffle_partitions=4, extra={
        "spark.ui.showConsoleProgress": "false", "spark.checkpoint.dir": tempfile.mkdtemp(prefix="ml-test-ckpt-"),
        "spark.driver.memory": "4g"})
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_fresh():
    return tempfile.mkdtemp(prefix="ml-test-")


SF_SMALL = "/root/testdata/sf0.001"
