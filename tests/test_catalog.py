"""Every registered query against its SQL, on the smallest tables."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent / "tools"))

import check_oracles  # noqa: E402

from wicketworks.catalog import ORACLES, QUERIES  # noqa: E402

DIRECTORY = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(DIRECTORY).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return check_oracles.connect(DIRECTORY)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert check_oracles.compare(spark, con, DIRECTORY, name)[1] is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
