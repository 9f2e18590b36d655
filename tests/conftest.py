import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lexitally.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = build_session(
        "local[4]", "tests",
        **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g", "spark.ui.showConsoleProgress": "false",
           "spark.checkpoint.dir": f"file://{shared}/checkpoints", "spark.sql.warehouse.dir": f"file://{shared}/warehouse"},
    )
    session.sparkContext.setLogLevel("ERROR")
    return session
