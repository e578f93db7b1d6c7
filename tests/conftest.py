from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

TESTDATA = Path("/root/testdata")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from quitanda.session import local_session

    settings = {
        "spark.sql.shuffle.partitions": "4",
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
    }
    session = local_session(8, "tests", **settings)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tiny() -> str:
    return str(TESTDATA / "sf0.001")


@pytest.fixture(scope="session")
def small() -> str:
    return str(TESTDATA / "sf0.01")
