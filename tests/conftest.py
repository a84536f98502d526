import pytest

from tabmill.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tests", spark__sql__shuffle__partitions="8", spark__driver__memory="8g")
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()
