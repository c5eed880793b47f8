import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from ledgerloom.session import local_session, ship  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session("4", 4, "tests")
    ship(s)
    return s


@pytest.fixture(scope="session")
def data():
    return "/root/testdata/sf0.001"
