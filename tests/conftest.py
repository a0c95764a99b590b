import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from mercatura.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        build_session(
            "tests",
            spark_master="local[8]",
            spark_sql_shuffle_partitions="8",
            spark_ui_enabled="false",
            spark_driver_memory="8g",
            spark_checkpoint_dir=tempfile.mkdtemp(prefix="mercatura-tests-", dir="/tmp"),
        )
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
