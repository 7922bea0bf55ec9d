import os

import pytest

from starglean.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "starglean-tests")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
