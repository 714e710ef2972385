"""Every registered query against its SQL, at the smallest scale."""

import pytest

from tallygraph.queries import ORACLES, QUERIES
from tests.oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, db, name):
    frame = QUERIES[name](spark, FOLDER)
    if name in ORACLES:
        assert compare(db, ORACLES[name], frame) is None
    else:
        assert frame.columns
        assert frame.count() > 0
