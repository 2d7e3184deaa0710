import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from shardlake.session import get_session
    scratch = tempfile.mkdtemp(prefix="shardlake-tests-")
    s = get_session("local[*]", 8, extra={"spark.sql.warehouse.dir": os.path.join(scratch, "warehouse")})
    # tests set their own checkpoint folder only where the session has none
    from shardlake.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(s, os.path.join(scratch, "checkpoints"))
    yield s


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="shardlake-run-")
