import pytest

from arborlex.llm.queries import QUERIES
from arborlex.llm.sql import ORACLES
from tests.conftest import SF
from tests.oracle import compare, connection


@pytest.fixture(scope="module")
def con():
    return connection(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_gives_what_sql_gives(spark, con, name):
    compare(spark, con, SF, QUERIES[name], ORACLES[name])


def test_the_ten_are_registered():
    assert sorted(int(n.split("_")[0][2:]) for n in QUERIES) == list(range(1, 11))
