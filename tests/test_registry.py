"""Every registered query against its SQL over the same files."""

import pytest

import __spark_entry__ as entry_points
from registry.compare import connect, differences
from registry.loading import LOADING_QUERIES, LOADING_SQL
from registry.models import MODEL_QUERIES, MODEL_SQL
from registry.operators import OPERATOR_QUERIES, OPERATOR_SQL

from tests.conftest import SMALL

SQL = {**MODEL_SQL, **OPERATOR_SQL, **LOADING_SQL}
QUERIES = {name: query for name, query in entry_points.queries().items() if name in SQL}


@pytest.fixture(scope="module")
def connection():
    return connect(SMALL)


def test_every_query_has_sql():
    assert {*MODEL_QUERIES, *OPERATOR_QUERIES, *LOADING_QUERIES} == set(SQL) == set(QUERIES)
    assert SQL.items() <= entry_points.oracle_sql().items()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_sql(spark, connection, name):
    assert differences(QUERIES[name](spark, SMALL), connection, SQL[name]) == []


def test_entry_has_rows(spark):
    found = entry_points.entry(spark)
    assert "rotation_rank" in found.columns and found.count() > 0
