import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tallystar.session import local_session

    s = local_session(4, shuffle_partitions=4, app_name="tallystar-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SMALL
