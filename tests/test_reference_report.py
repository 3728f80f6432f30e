"""References: one aggregate of all values, in their own type."""

from __future__ import annotations

from helpers import plan, rows

from clinspark.operators import audit


def test_references_are_one_aggregate_of_whole_numbers(spark):
    child = spark.sql("select * from values (1, 5L), (2, 6L), (null, 6L), (1, null) as t(a, b)")
    tables = {"child": child, "p": spark.sql("select * from values (1L), (1L) as t(id)"),
              "q": spark.sql("select * from values (5S), (null) as t(id)")}
    keys = [audit.ForeignKey("child", "a", "p"), audit.ForeignKey("child", "b", "q"), audit.ForeignKey("child", "b", "p")]
    report = audit.reference_report(tables, keys)
    text = plan(report)
    assert text.count("hashpartitioning(parent") == 2  # of all values, and of the sums
    assert "as string" not in text
    assert rows(report) == [("child", "a", 4, 1, 1), ("child", "b", 4, 1, 2), ("child", "b", 4, 1, 3)]


def test_references_of_several_types_are_text(spark):
    tables = {"child": spark.sql("select * from values (1), (2) as t(a)"), "p": spark.sql("select * from values ('1') as t(id)")}
    assert rows(audit.reference_report(tables, [audit.ForeignKey("child", "a", "p")])) == [("child", "a", 2, 0, 1)]
