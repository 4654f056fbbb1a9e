import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from martloom.session import local_session

    shared = {"spark.checkpoint.dir": tempfile.mkdtemp(prefix="martloom-tests-")}
    session = local_session(8, shuffle_partitions=4, memory="6g", app="tests", settings=shared)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="martloom-case-")
