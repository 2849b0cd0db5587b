import pytest


@pytest.fixture()
def sf_dir():
    return "/root/testdata/sf0.001"
