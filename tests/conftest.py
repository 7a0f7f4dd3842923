import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from panelith.session import build_session, clear_scratch

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("local[4]", **{
        "spark.sql.shuffle.partitions": "4", "spark.log.level": "ERROR", "spark.driver.memory": "8g",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
    })
    yield session
    clear_scratch(session)
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF
