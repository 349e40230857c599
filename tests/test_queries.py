"""Every registered query against its SQL, over whole tables."""

import pytest

from tests.oracle import compare, connect
from tokenloom.plans import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, con, name):
    same, note = compare(spark, con, QUERIES[name], ORACLES[name], FOLDER)
    assert same, note


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_gives_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_known_token_totals(spark):
    row = QUERIES["supervised_tokens"](spark, FOLDER).selectExpr("count(*)", "sum(n_tokens)", "sum(n_supervised)").first()
    assert tuple(row) == (6, 2885, 909)
