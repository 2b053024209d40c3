import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from termtide.session import session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    made = session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
        },
    )
    made.sparkContext.setLogLevel("ERROR")
    yield made
    made.stop()


@pytest.fixture(autouse=True)
def forget_ended_streams(request):
    """A stream that fails on purpose in one test must not surface in another that waits for any."""
    yield
    if "spark" in request.fixturenames:
        request.getfixturevalue("spark").streams.resetTerminated()


@pytest.fixture(scope="session")
def small():
    return SMALL


@pytest.fixture
def folder(tmp_path):
    """A fresh folder name that does not exist yet."""
    return str(tmp_path / "data")
