"""Queries with SQL, held against it over the tables of scale 0.01."""

import pytest

from orogrid.llm import queries

SQL = queries.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(name, matches):
    matches(queries.queries()[name], SQL[name])
