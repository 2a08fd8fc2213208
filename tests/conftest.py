import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from lodgeframe.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", 8, app="lodgeframe-tests")
    yield s


@pytest.fixture(scope="session")
def sf_small():
    return SF_SMALL
