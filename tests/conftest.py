import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from millrace.session import build_session


@pytest.fixture(scope="session")
def spark():
    conf = {
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": "4",
        "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false",
    }
    session = build_session("tests", "local[8]", conf)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a frame as sorted tuples."""

    def collect(df, *columns):
        return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)

    return collect
