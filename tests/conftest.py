import pytest

from lotmill.session import get_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_session("tests", "local[8]", spark__sql__shuffle__partitions="4", spark__driver__memory="6g",
                          spark__ui__enabled="false", spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("wh")))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
