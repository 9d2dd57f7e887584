import pytest

from vinework.runtime import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "vinework-tests", **{"spark.driver.memory": "6g"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
