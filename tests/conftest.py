import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tools")]

from tarmac.session import local_session  # noqa: E402
from tarmac.testbed import testbed  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", "tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def bed(spark):
    return testbed(spark, SMALL)


@pytest.fixture(scope="session")
def star(bed):
    return bed.star
