from __future__ import annotations

import datetime as dt
import random

import pytest
from helpers import plan, rows

from clinspark.operators.visit_store import VisitStore
from clinspark.operators.visits import number_visits, roll_up_visits, visit_cells, visit_of_encounter

SCHEMA = "id int, patient string, class string, start timestamp_ntz, stop timestamp_ntz"
BY = ["patient", "class"]


def encounters(seed, n):
    source = random.Random(seed)
    day = lambda: dt.datetime(2020, 1, 1) + dt.timedelta(hours=source.randrange(24 * 120))
    return [
        (i, source.choice(["a", "b", "c", None]), source.choice(["x", "y"]), None if source.random() < 0.05 else day(),
         day() if source.random() < 0.2 else None)
        for i in range(n)
    ]


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 0, 1)])
def test_loads_in_any_order_equal_one_load(spark, staging, order):
    found = encounters(1, 90)
    df = spark.createDataFrame(found, SCHEMA)
    store = VisitStore(spark, staging.path(f"visits{order[0]}"), BY, gap_days=3)
    for part in order:
        store.add(f"part {part}", df.where(f"id % 3 = {part}"), staging)
    want = roll_up_visits(df, BY, gap_days=3)
    assert rows(store.visits(), *want.columns) == rows(want)
    ids = lambda cells: visit_of_encounter(df, number_visits(cells, BY, staging)[1], BY, gap_days=3)
    assert rows(ids(store.cells())) == rows(ids(visit_cells(df, BY, gap_days=3)))
    assert "Python" not in plan(store.visits())


def test_repeated_load_replaces_itself(spark, staging):
    one, two = spark.createDataFrame(encounters(2, 40), SCHEMA), spark.createDataFrame(encounters(3, 40), SCHEMA)
    store = VisitStore(spark, staging.path("visits"), BY)
    store.add("one", one, staging)
    store.add("two", two, staging)
    store.add("one", one, staging)
    want = roll_up_visits(one.union(two), BY)
    assert rows(store.visits(), *want.columns) == rows(want)
    store.add("one", one.limit(0), staging)
    assert rows(store.visits(), *want.columns) == rows(roll_up_visits(two, BY))


def test_only_touched_patients_are_rolled_up(spark, staging):
    df = spark.createDataFrame(encounters(4, 60), SCHEMA)
    store = VisitStore(spark, staging.path("visits"), ["patient"])
    store.add("all", df.where("patient is distinct from 'c'"), staging)
    given = store.add("more", df.where("patient = 'c' or id = 0"), staging)
    touched = {"c", df.where("id = 0").first()["patient"]}
    assert {r["patient"] for r in given.collect()} == touched
    assert {r["patient"] for r in spark.read.parquet(f"{store.path}/rolled/version=1").collect()} == touched


def test_broken_load(spark, staging, monkeypatch):
    df = spark.createDataFrame(encounters(5, 60), SCHEMA)
    store = VisitStore(spark, staging.path("visits"), BY)
    with pytest.raises(ValueError):
        store.cells()
    store.add("first", df.where("id % 2 = 0"), staging)
    before = rows(store.visits())
    with monkeypatch.context() as patched:
        patched.setattr("clinspark.operators.visit_store.chain_cells", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            store.add("second", df.where("id % 2 = 1"), staging)
    assert rows(store.visits()) == before
    store.add("third", df.limit(0), staging)  # rolls up what the second load stored
    want = roll_up_visits(df, BY)
    assert rows(store.visits(), *want.columns) == rows(want)
