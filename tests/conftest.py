import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from lendlake.session import get_session

    scratch = tempfile.mkdtemp(prefix="lendlake-tests-")
    s = get_session(
        app="lendlake-tests",
        master="local[4]",
        shuffle_partitions=4,
        extra={
            "spark.checkpoint.dir": os.path.join(scratch, "ckpt"),
            "spark.local.dir": os.path.join(scratch, "local"),
            "spark.sql.warehouse.dir": os.path.join(scratch, "warehouse"),
        },
    )
    yield s
    s.stop()


SMOKE = "/root/testdata/sf0.001"
