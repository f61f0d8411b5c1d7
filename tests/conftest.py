from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from obslake.session import local_session

    session = local_session(4, shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return SMALL


def rows(df, *order):
    """Collected rows as tuples, sorted."""
    ordered = df.orderBy(*order) if order else df
    found = [tuple(r) for r in ordered.collect()]
    return found if order else sorted(found, key=repr)


def same(a, b) -> bool:
    """Equal as bags of rows."""
    columns = sorted(a.columns)
    assert columns == sorted(b.columns)
    a, b = a.select(*columns), b.select(*columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
