import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stallkeeper.session import CHECKPOINT_KEY, build_session, name_staging_root  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", cores="8", shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    if not session.conf.get(CHECKPOINT_KEY, None):
        name_staging_root(session, tempfile.mkdtemp(prefix="stallkeeper-"))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def shop(spark):
    from stallkeeper.sources.adapters import Shop

    return Shop(spark, SF_DIR)


@pytest.fixture
def folder(spark):
    from stallkeeper.session import staging_path

    return lambda label="t": staging_path(spark, label)
