import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))


@pytest.fixture(scope="session")
def spark():
    from skillgrid.session import build_session

    session = build_session(
        "local[8]", "tests", **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "8g", "spark.ui.enabled": "false"}
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
