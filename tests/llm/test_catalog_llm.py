"""Every query of this subpackage on the smallest tables, against SQL where there is some."""

from __future__ import annotations

import pytest
from compare import connect, spark_rows, sql_rows

from knotwork.llm import queries


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, data, name):
    got = spark_rows(queries.QUERIES[name](spark, data))
    if name in queries.SQL:
        assert got == sql_rows(connect(data), queries.SQL[name])
    else:
        assert got[1]
