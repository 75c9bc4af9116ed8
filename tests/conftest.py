import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from weftline.session import build_session, clear_cuts  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", master="local[4]", shuffle_partitions=4,
                            **{"spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")), "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
                               "spark.driver.memory": "6g"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    clear_cuts(session)
    session.stop()
