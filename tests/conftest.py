import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from txnwatch.session import local_session
    s = local_session("*", 4)
    yield s
    s.stop()


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def rows(df, *cols):
    """Sorted list of tuples of the given columns (all columns when none given)."""
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
