import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from clickloom.session import local_session  # noqa: E402
from clickloom.workspace import release  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, shuffle_partitions=8)
    yield session
    release(session)


@pytest.fixture
def small_scans(spark):
    """Cut even small files into several scan partitions."""
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "16k")
    yield
    spark.conf.set(key, before)
