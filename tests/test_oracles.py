"""Every registered query against its SQL twin on the smallest tables."""

import pytest

import __spark_entry__ as contract
import oracle

ORACLES = contract.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    return oracle.connect(sf)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equal(spark, con, sf, name):
    why = oracle.compare(spark, con, contract.queries()[name], ORACLES[name], sf)
    # A rule may find nothing in tables this small.
    assert why is None or why == "no rows to compare", why


@pytest.mark.parametrize("name", sorted(set(contract.queries()) - set(ORACLES)))
def test_has_rows(spark, sf, name):
    assert contract.queries()[name](spark, sf).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(contract.queries())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["feature", "type", "metric", "score", "is_drifted"]
    assert df.count() == 3
