import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from shelfcast.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        app="tests",
        master="local[4]",
        shuffle_partitions=4,
        extra={"spark.driver.memory": "6g", "spark.checkpoint.dir": tempfile.mkdtemp(prefix="shelfcast-"), "spark.ui.showConsoleProgress": "false"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
