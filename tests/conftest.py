from __future__ import annotations

import pytest

from hoptrail.session import local_session

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores=8, shuffle_partitions=4, memory="4g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small() -> str:
    return SMALL
