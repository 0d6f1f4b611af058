import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from kpiframe.session import ensure_checkpoint_dir, local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", shuffle_partitions=8, app="kpiframe-tests")
    ensure_checkpoint_dir(s, tempfile.mkdtemp(prefix="kpiframe-ckpt-"))
    yield s
    s.stop()


def one(df):
    rows = df.collect()
    assert len(rows) == 1, rows
    return rows[0]
