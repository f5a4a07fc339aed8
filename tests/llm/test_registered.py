import pytest

from check import connect, difference
from conftest import SF_DIR
from gondola.llm import queries


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.registered()) == list(range(1, 14))
    assert set(queries.oracle()) <= set(queries.registered())


@pytest.mark.parametrize("name", sorted(queries.oracle()))
def test_query_matches_sql(spark, name):
    assert difference(queries.registered()[name](spark, SF_DIR), connect(SF_DIR), queries.oracle()[name]) is None
