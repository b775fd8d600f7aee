import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from panelspark.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    home = tmp_path_factory.mktemp("spark")
    session = local_session(
        8, "tests", spark__sql__warehouse__dir=str(home / "warehouse"), spark__checkpoint__dir=str(home / "checkpoints"),
        spark__sql__shuffle__partitions="4",
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
