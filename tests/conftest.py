import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from slackline.session import local_session  # noqa: E402

TABLES = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, memory="4g", app="tests")
    yield session
    session.stop()


@pytest.fixture
def conf(spark):
    """Set session options for one test."""
    before = {}

    def change(name, value):
        before.setdefault(name, spark.conf.get(name))
        spark.conf.set(name, value)

    yield change
    for name, value in before.items():
        spark.conf.set(name, value)


def values(df, *columns):
    """Sorted tuples of the given columns, None first."""
    rows = [tuple(r[c] for c in (columns or df.columns)) for r in df.collect()]
    return sorted(rows, key=lambda r: tuple((v is not None, v) for v in r))
