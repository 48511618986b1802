import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from layercake.session import local_session

    s = local_session(4, 4, app="layercake-tests")
    yield s
    s.stop()


def rows(df, *cols):
    """Collected rows as plain tuples (optionally a column subset), sorted."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=lambda t: tuple((x is None, str(x)) for x in t))
