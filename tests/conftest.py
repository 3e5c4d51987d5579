import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quireflow.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(cpus=4, shuffle_partitions=4, app="tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df):
    """The rows of a frame as a sorted list of tuples."""
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def get():
    return rows
