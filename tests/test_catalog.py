"""Every core query against its SQL on the smallest tables."""

from __future__ import annotations

import pytest
from compare import connect, spark_rows, sql_rows

from knotwork.plans import catalog_concepts, catalog_graph, catalog_links, catalog_more, catalog_text, problems

MODULES = (problems, catalog_links, catalog_graph, catalog_concepts, catalog_text, catalog_more)
QUERIES = {n: f for m in MODULES for n, f in m.QUERIES.items()}
SQL = {n: s for m in MODULES for n, s in m.SQL.items()}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, data, name):
    got = spark_rows(QUERIES[name](spark, data))
    if name in SQL:
        assert got == sql_rows(connect(data), SQL[name])


def test_sql_has_queries():
    assert set(SQL) <= set(QUERIES)
