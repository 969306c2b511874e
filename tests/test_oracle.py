"""Every registered query against its SQL twin, or for having rows where there is none."""

import pytest
from compare import connect, differences

from gaugeloom.plans.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, db, name):
    if name in ORACLES:
        assert differences(spark, db, FOLDER, name, QUERIES[name], ORACLES[name]) is None
    else:
        assert QUERIES[name](spark, FOLDER).count() > 0


def test_every_twin_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
