"""Every registered query against its SQL on the supplied tables."""

from __future__ import annotations

import pytest
from compare import connect, differences
from helpers import plan

import __spark_entry__ as entry_module
from clinspark.oracle import ORACLE_SQL
from clinspark.queries import QUERIES


KNOWN_COUNTS = {
    "launch_trim": 8200, "orphans": 23321, "delete_orphans": 36679, "dedup_by_id": 45832, "dedup_rows": 57252,
    "codes_snomed": 56, "codes_loinc": 25, "codes_cvx": 500, "pk_audit": 11785, "history_window": 6937,
    "visit_rollup": 13226, "note_files": 536,
}


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(ORACLE_SQL) == set(QUERIES)
    assert set(QUERIES) <= set(entry_module.queries())
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


def no_python_and_no_pair_joins(df):
    text = plan(df)
    for bad in ("PythonUDF", "ArrowEvalPython", "BatchEvalPython", "MapInPandas", "CartesianProduct",
                "BroadcastNestedLoopJoin"):
        assert bad not in text, bad


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_equals_sql(spark, con, sf_dir, name):
    problem, n, _ = differences(spark, con, sf_dir, name, no_python_and_no_pair_joins)
    assert problem is None
    assert n == KNOWN_COUNTS.get(name, n)


def test_entry_has_rows(spark):
    df = entry_module.entry(spark)
    assert "encounter" in df.columns
    assert df.count() > 0
