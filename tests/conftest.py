import os
import sys
import uuid

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.session import build_session  # noqa: E402

TESTDATA = os.environ.get("TESTDATA", "/root/testdata")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tidemark-tests",
        "local[8]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="4g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def database():
    return f"test_{uuid.uuid4().hex}"
