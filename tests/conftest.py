import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]


@pytest.fixture(scope="session")
def spark():
    from lexharbor.session import local_session

    session = local_session(4, "4g", "lexharbor-tests")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()
