import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from strata.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(cpus=8, memory="8g", app="strata-tests")
    yield session
    session.stop()


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def rows(df, *columns):
    """Rows as a sorted list of tuples."""
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in chosen.collect()), key=repr)
