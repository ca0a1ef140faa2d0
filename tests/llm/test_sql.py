import pytest

from fieldloom.llm import queries
from fieldloom.llm.url_filter import EXTRA
from oracle import by_duckdb, by_spark


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_against_sql(spark, name):
    sf = "/root/testdata/sf0.01"
    got, want = by_spark(queries.QUERIES[name](spark, sf)), by_duckdb(queries.ORACLES[name], sf)
    assert len(got) == len(want)
    assert got == want


def test_globs_of_the_sql_are_those_of_the_rules():
    assert [(v, g) for v, g, _ in queries.GLOBS] == list(EXTRA)
