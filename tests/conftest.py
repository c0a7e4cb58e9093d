import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from darkroom.session import local_session

    s = local_session("*", shuffle_partitions=8, checkpoint_dir=tempfile.mkdtemp(prefix="darkroom-test-ckpt-"))
    yield s
    s.stop()
