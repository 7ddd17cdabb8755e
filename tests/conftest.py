import pytest

from postlens.session import get_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_session("tests", spark__master="local[4]", spark__ui__enabled="false",
                          spark__sql__shuffle__partitions="4", spark__driver__memory="4g",
                          spark__checkpoint__dir=str(tmp_path_factory.mktemp("scratch")))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
