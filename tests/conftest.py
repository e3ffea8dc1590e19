import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from tidemark.session import spark_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = spark_session(
        "tests", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__driver__memory="8g", spark__sql__warehouse__dir=tempfile.mkdtemp(prefix="tidemark-warehouse-"))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
