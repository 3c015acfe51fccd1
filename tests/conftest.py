import math
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from riskloom.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[*]", 8, "8g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return SMALL


def rows_of(df, keys=None):
    """Rows as comparable tuples, doubles to nine places, in a fixed order."""
    def cell(v):
        return round(v, 9) + 0.0 if isinstance(v, float) else v

    columns = sorted(keys or df.columns)
    return sorted((tuple(cell(r[c]) for c in columns) for r in df.select(*columns).collect()), key=repr)


def same_rows(left, right, keys=None):
    """Equal rows in any order; doubles may differ in their last digits, as sums are added in another order."""
    columns = sorted(keys or left.columns)
    text = [c for c in columns if dict(left.dtypes)[c] != "double"]

    def ordered(df):
        return sorted(df.select(*columns).collect(), key=lambda r: (
            repr([r[c] for c in text]), [(r[c] is None, r[c] or 0.0) for c in columns if c not in text]))

    a, b = ordered(left), ordered(right)
    assert len(a) == len(b)
    for x, y in zip(a, b):
        for c in columns:
            close = isinstance(x[c], float) and isinstance(y[c], float) and math.isclose(x[c], y[c], rel_tol=1e-9, abs_tol=1e-8)
            assert x[c] == y[c] or close, (c, x, y)
    return True
