import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from skyfold.session import get_session
    s = get_session("local[4]", shuffle_partitions=4, app_name="skyfold-tests")
    yield s


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="skyfold-test-")


def rows(df, *cols):
    """Collect as a list of tuples (small test frames only)."""
    cols = cols or tuple(df.columns)
    return [tuple(r[c] for c in cols) for r in df.select(*cols).collect()]
