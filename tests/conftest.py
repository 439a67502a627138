import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from sonolode.session import local_session, ship

    session = local_session(4, **{"spark.sql.shuffle.partitions": "4"})
    ship(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return SMALL
