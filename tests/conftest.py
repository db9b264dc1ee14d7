import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tools.local_session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local_session("8")


@pytest.fixture(scope="session")
def sf():
    return SMALL


@pytest.fixture
def folder(spark):
    from siltstone.session import fresh_dir

    return lambda label="test": fresh_dir(spark, label)
