import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

from flatloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    # Test runs keep their scratch tables to themselves.
    scratch = str(tmp_path_factory.mktemp("scratch"))
    settings = {"spark.checkpoint.dir": scratch, "spark.sql.shuffle.partitions": "8"}
    session = local_session(8, memory="8g", **settings)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
