"""Registered queries of this subpackage against their SQL."""

from __future__ import annotations

import pytest
from compare import connect, rows_of

from clinspark.llm.queries import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_equals_sql(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    cursor = connect(sf_dir).execute(ORACLE_SQL[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(columns, cursor.fetchall())
