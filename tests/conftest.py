"""One local session for all tests; its shared folder is a temporary one."""

import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tradeloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    # Where nothing else is set, the session is made with a shared folder of its own.
    SparkSession.builder.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tradeloom-"))
    session = local_session(cores=8, shuffle_partitions=4)
    yield session
    session.stop()
