import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from specspark.session import local_session

    session = local_session("8", 8, checkpoint_dir=tempfile.mkdtemp(prefix="ckpt-"))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF
