import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from rinkstat.session import build_session

    s = build_session("local[4]", app_name="rinkstat-tests", shuffle_partitions=8)
    yield s
    s.stop()


def rows(df, *order):
    """Collect as sorted list of dicts (tests only; small fixtures)."""
    out = [r.asDict(recursive=True) for r in df.collect()]
    key = order or tuple(sorted(out[0].keys())) if out else ()
    return sorted(out, key=lambda d: tuple((d[k] is None, d[k]) for k in key))
