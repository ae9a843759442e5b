import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from fleetbook.session import ensure_checkpoint_dir, local_session

    s = local_session(shuffle_partitions=8, app="fleetbook-tests")
    ensure_checkpoint_dir(s, tempfile.mkdtemp(prefix="fleetbook-test-", dir="/tmp"))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def seed(spark):
    from tests.seed import seed_tables

    return seed_tables(spark)
