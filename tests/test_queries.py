"""All queries of the core against SQL, or at least run, on the smallest tables."""

import pytest

from pagelode.plans import operator_queries, problem_queries, reference_queries
from tests.sqlcheck import BASE, compare, duck  # noqa: F401

QUERIES = {**reference_queries.QUERIES, **operator_queries.QUERIES, **problem_queries.QUERIES}
SQL = {**reference_queries.ORACLE, **operator_queries.ORACLE, **problem_queries.ORACLE}


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, duck, name):  # noqa: F811
    compare(spark, duck, QUERIES[name], SQL[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, duck, name):  # noqa: F811
    assert QUERIES[name](spark, BASE).count() > 0


def test_entry(spark, duck):  # noqa: F811
    import __spark_entry__ as e

    assert e.entry(spark).count() >= 0 and set(QUERIES) <= set(e.queries()) and set(SQL) <= set(e.oracle_sql())


def test_the_core_does_not_import_the_optional_package():
    import re
    from pathlib import Path

    root = Path(problem_queries.__file__).resolve().parents[1]
    for p in root.rglob("*.py"):
        if "llm" not in p.relative_to(root).parts:
            assert not re.search(r"pagelode\.llm|from \.+llm", p.read_text()), p
