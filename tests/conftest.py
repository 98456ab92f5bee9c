import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from workload.check import session
    from zephyrine.session import configure

    made = configure(session())
    yield made
    made.stop()


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="zephyrine-test-")


def rows(df, *columns):
    """Collected rows as tuples, sorted."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: tuple(map(repr, r)))
