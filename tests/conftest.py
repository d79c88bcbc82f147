import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tillcast.session import get_session
    s = get_session("local[*]", app="tillcast-tests", shuffle_partitions=8)
    yield s
    s.stop()


def rows(df, *cols):
    out = df.select(*cols) if cols else df
    return [tuple(r) for r in out.collect()]
