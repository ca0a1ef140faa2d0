import pytest

from fieldloom.plans.catalog import ORACLES, QUERIES
from oracle import by_duckdb, by_spark


@pytest.mark.parametrize("name", list(QUERIES))
def test_against_sql(spark, name):
    sf = "/root/testdata/sf0.01"
    got, want = by_spark(QUERIES[name](spark, sf)), by_duckdb(ORACLES[name], sf)
    assert len(got) == len(want)
    assert got == want
