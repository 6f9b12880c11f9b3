import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from loomtext.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", app="loomtext-tests", shuffle_partitions=8)
    yield s
    s.stop()


def rows(df, *cols):
    """Sorted tuples of the given columns (all columns by default)."""
    sel = df.select(*cols) if cols else df
    key = lambda t: tuple((x is None, type(x).__name__, x if x is not None else 0) for x in t)
    return sorted((tuple(r) for r in sel.collect()), key=key)
