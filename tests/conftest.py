import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tessera.session import get_session
    s = get_session("local[*]", shuffle_partitions=8)
    yield s


@pytest.fixture()
def tmp_base(spark):
    from tessera.session import scratch_path
    return scratch_path(spark, "test")


def rows(df, order=None):
    """Collect as a sorted list of tuples (order-insensitive compare)."""
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((x is None, str(x)) for x in t))
