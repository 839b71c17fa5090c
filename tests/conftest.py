import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerwing.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        os.environ.get("TEST_MASTER", "local[8]"),
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="8g",
        spark__sql__warehouse__dir="/tmp/ledgerwing-test-warehouse",
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="ledgerwing-tests-"),
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()
