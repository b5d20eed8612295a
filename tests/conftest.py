import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from stratus.session import get_spark
    s = get_spark("local[4]", app="stratus-tests", shuffle_partitions=8)
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="stratus-test-ckpt-"))
    yield s


@pytest.fixture()
def tmp_table(tmp_path):
    return str(tmp_path / "table")
