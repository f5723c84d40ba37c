import pytest

from subscope.settings import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = str(tmp_path_factory.mktemp("warehouse"))
    session = local_session(cores=8, shuffle_partitions=4, warehouse=warehouse)
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.01"
