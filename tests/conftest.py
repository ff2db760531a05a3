import os

import pytest

os.environ.setdefault("SPARK_LOCAL_IP", "127.0.0.1")


@pytest.fixture(scope="session")
def spark():
    from murmurate.session import local_session

    s = local_session("tests", cores=4, partitions=4)
    s.sparkContext.setLogLevel("OFF")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def data():
    d = "/root/testdata/sf0.001"
    if not os.path.isdir(d):
        pytest.skip("no test tables here")
    return d
