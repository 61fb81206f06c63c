import pytest

from custgraph.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(partitions=4, memory="8g")
    yield session
    session.stop()


@pytest.fixture(autouse=True)
def _clear(spark):
    yield
    spark.catalog.clearCache()
