import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))


@pytest.fixture(scope="session")
def spark():
    from panelcast.session import get_session
    ckpt = tempfile.mkdtemp(prefix="panelcast-test-ckpt-")
    s = get_session("local[4]", app="panelcast-tests", shuffle_partitions=4,
                    conf={"spark.checkpoint.dir": ckpt})
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="panelcast-test-")
