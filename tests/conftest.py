import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from meterlens.session import ensure_test_checkpoint_dir, local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", shuffle_partitions=8, app="meterlens-tests")
    ensure_test_checkpoint_dir(s)
    yield s


def rows(df, order=None):
    out = [r.asDict() for r in (df.orderBy(*order) if order else df).collect()]
    return out
