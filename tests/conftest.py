import os

import pytest

from statlab.session import local_session

os.environ.setdefault("STATLAB_DRIVER_MEMORY", "4g")


@pytest.fixture
def no_broadcast(spark):
    """Joins of tables that are too large to broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.fixture(scope="session")
def spark():
    session = local_session("statlab-tests")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
