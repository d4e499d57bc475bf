import pytest

from pagelode.llm.queries import QUERIES
from pagelode.llm.sql import ORACLE
from tests.sqlcheck import BASE, compare, duck  # noqa: F401


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):  # noqa: F811
    if name in ORACLE:
        compare(spark, duck, QUERIES[name], ORACLE[name])
    else:
        assert QUERIES[name](spark, BASE).count() > 0
