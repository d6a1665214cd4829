import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from shoptally.session import build_session, remove_scratch

    shared = tmp_path_factory.mktemp("shared")

    session = build_session(
        "tests", "local[8]", 8, **{"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g", "spark.checkpoint.dir": str(shared)}
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    remove_scratch(session)
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
