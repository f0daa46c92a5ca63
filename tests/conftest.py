import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tools")]

from lakeline.session import local_session  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", "8", spark__driver__memory="6g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return FOLDER
