import pytest

from quirefold.session import build_session


@pytest.fixture(scope="session")
def spark():
    return build_session("quirefold-tests", cpus=4, spark__sql__shuffle__partitions="4")
