import pytest

from platterflow.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session("tests", str(tmp_path_factory.mktemp("shared")), "8", partitions=8)
    yield session
    session.stop()


@pytest.fixture
def many_slices(spark):
    """Keeps AQE from merging the small partitions of a test, so slices and offsets matter."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    yield
    spark.conf.set(key, before)
