from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from weftgraph.session import local_session

    session = local_session(8, partitions=4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small() -> str:
    return SMALL
