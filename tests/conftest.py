import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from loamline.session import local_session

    return local_session(8, "4g")


@pytest.fixture
def folder(spark):
    """A fresh folder below the shared one."""
    from loamline.staging import new_path

    path = new_path(spark, "test")
    os.makedirs(path)
    return path
