import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from concord.session import local_session  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, shuffle_partitions=4, app="concord-tests")
    yield s


def _cell(v):
    # NaN never equals itself in Python; Spark groups all NaNs as one value
    return "NaN" if isinstance(v, float) and v != v else v


def rows(df):
    return sorted((tuple(_cell(v) for v in r) for r in df.collect()), key=repr)


def one(df):
    r = df.collect()
    assert len(r) == 1, r
    return r[0].asDict()
