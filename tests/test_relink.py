from __future__ import annotations

import pytest
from helpers import rows, ts
from pyspark.sql import Window
from pyspark.sql import functions as F

from clinspark.operators.relink import (
    add_first_encounter, delete_orphans, drop_null_encounter, first_encounter_of_each_row, first_encounters,
    orphans, reassign_orphans,
)
from clinspark.plans.relink import relink_tables
from clinspark.spec import CLINICAL_TABLES


@pytest.fixture(scope="module")
def encounters(spark):
    return spark.createDataFrame([
        ("e2", "p1", ts("2011-01-01")), ("e1", "p1", ts("2011-01-01")), ("e3", "p1", ts("2012-01-01")),
        ("e5", "p2", None), ("e4", "p2", ts("2013-01-01")),
        ("e7", "p3", None), ("e6", "p3", None),
        ("e8", None, ts("2010-05-01")), ("e9", None, ts("2010-06-01")),
    ], "id string, patient string, start timestamp_ntz")


@pytest.fixture(scope="module")
def patients(spark):
    return spark.createDataFrame([("p1",), ("p2",), ("p3",), ("p4",)], "id string")


@pytest.fixture(scope="module")
def child(spark):
    return spark.createDataFrame([
        (1, "p1", "e3"), (2, "p1", "gone"), (3, "p2", "gone"), (4, "p4", "gone"), (5, None, "lost"),
        (6, "p9", "lost"), (7, "p1", None), (8, "p2", "e1"), (9, "p1", "gone"),
    ], "n int, patient string, encounter string")


def test_first_encounter_ties_and_nulls(patients, encounters):
    got = rows(add_first_encounter(patients, encounters))
    assert got == [("p1", "e1"), ("p2", "e4"), ("p3", "e6"), ("p4", None)]


def test_first_value_of_each_row_agrees_with_a_window(encounters, staging):
    order = Window.partitionBy("patient").orderBy(F.asc_nulls_last("start"), "id")
    window = encounters.withColumn("first_encounter_id", F.first("id").over(order))
    assert rows(first_encounter_of_each_row(encounters)) == rows(window)


def test_orphans(child, encounters):
    assert rows(orphans(child, encounters), "n") == [(2,), (3,), (4,), (5,), (6,), (9,)]


@pytest.mark.parametrize("staged", [False, True])
def test_reassign(child, encounters, staging, staged):
    stage = {"stage": staging} if staged else {}
    out = reassign_orphans(child, encounters, first_encounters(encounters), **stage)
    assert out.columns == child.columns
    assert rows(out, "n", "encounter") == [
        (1, "e3"), (2, "e1"), (3, "e4"), (4, None), (5, None), (6, None), (7, None), (8, "e1"), (9, "e1")]
    again = reassign_orphans(out, encounters, first_encounters(encounters))
    assert rows(again) == rows(out)
    assert orphans(out, encounters).count() == 0


def test_delete(child, encounters):
    kept = delete_orphans(child, encounters)
    assert kept.columns == orphans(child, encounters).columns == child.columns
    assert rows(kept, "n") == [(1,), (7,), (8,)]
    assert kept.count() + orphans(child, encounters).count() == child.count()
    assert rows(delete_orphans(child, encounters, keep_null=False), "n") == [(1,), (8,)]
    assert rows(drop_null_encounter(kept), "n") == [(1,), (8,)]


def test_policies(child, encounters, patients):
    specs = {t.name: t for t in CLINICAL_TABLES}
    tables = {"patients": patients, "encounters": encounters, "conditions": child, "procedures": child,
              "observations": child, "claims": child}
    linked = relink_tables(tables, specs)
    assert linked["patients"].columns == ["id", "first_encounter_id"]
    assert linked["conditions"].count() == 9
    assert linked["procedures"].count() == 3
    assert linked["observations"].count() == 2
    assert linked["claims"] is child
