import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from carewatch.session import get_spark
    s = get_spark("carewatch-tests", master="local[*]", shuffle_partitions=8)
    yield s
    s.stop()


def rows(df, *cols):
    """Collect as plain tuples in a stable order."""
    sel = df.select(*cols) if cols else df
    return sorted([tuple(r) for r in sel.collect()], key=repr)
