"""Hard negatives against SQL and a plain search of all pairs."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from clinspark.llm import hard_negatives
from clinspark.llm.hard_negatives import mine_negatives

KIND = "vec_id long, label int, embedding array<double>, start int, id string"


def brute(rows, is_anchor):
    usable = [
        (i, label, [math.floor(256 * x) if abs(256 * x) < math.inf else int(math.copysign(np.finfo(float).max, x)) for x in v])
        for i, label, v in rows
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a in {(i, label, tuple(v)) for i, label, v in usable if is_anchor(i)}:
        scored = []
        for i, label, v in usable:
            if len(v) == len(a[2]):
                score = min(max(sum(x * y for x, y in zip(a[2], v)), -2**63 + 2), 2**63 - 2)
                scored.append((-score, i, label))
        scored.sort()
        for p, i, label in [s for s in scored if s[2] == a[1] and s[1] != a[0]][:5]:
            found = [(n, j) for n, j, other in scored if other != a[1] and 30 * -p <= 100 * -n <= 90 * -p]
            out += [(a[0], i, k, j, -p, -n) for k, (n, j) in enumerate(found[:10], 1)]
    return sorted(out)


def mined(spark, staging, rows, is_anchor=lambda c: c % 100 == 0, **options):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], KIND).repartition(5)
    return sorted(tuple(r) for r in mine_negatives(df, is_anchor(F.col("vec_id")), staging, **options).collect())


@pytest.mark.parametrize("seed,spread", [(1, 0.2), (2, 0.01), (3, 3.0)])
def test_against_brute_force(spark, staging, seed, spread):
    rng = random.Random(seed)
    centre = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(3)]
    rows = [(i, rng.randrange(4), [x + rng.gauss(0, spread) for x in rng.choice(centre)]) for i in range(400)]
    got = mined(spark, staging, rows, lambda c: c % 10 == 0)
    assert got == brute(rows, lambda i: i % 10 == 0) and got


def test_waves_change_nothing(spark, staging):
    rng = random.Random(5)
    rows = [(i, i % 3, [rng.random() for _ in range(4)]) for i in range(300)]
    got = mined(spark, staging, rows, lambda c: c % 20 == 0, wave_bytes=8 * 8 * 4)
    assert got == brute(rows, lambda i: i % 20 == 0) and got


def test_ties_and_groups_of_copies(spark, staging):
    """A third of all rows are one vector; equal scores go by the id, over blocks and tasks too."""
    rng = random.Random(6)
    rows = [(i, i % 2, [0.5, 0.5] if i % 3 else [rng.choice([0.25, 0.75]), 0.5]) for i in range(5000)]
    rng.shuffle(rows)
    got = mined(spark, staging, rows, lambda c: c % 1000 == 0)
    assert got == brute(rows, lambda i: i % 1000 == 0)


def test_edges(spark, staging):
    big, huge, tiny = 1e15, 1e200, 1e-200
    rows = [
        (0, 1, [0.5, 0.25]), (0, 1, [0.5, 0.25]), (1, 1, [0.5, 0.5]), (2, 2, [0.25, 0.25]), (2, 2, [0.25, 0.25]), (3, 2, [0.1, 0.2]),
        (4, None, [0.3, 0.3]), (None, 2, [0.3, 0.3]), (5, 2, None), (6, 2, [0.3, None]), (7, 2, [math.nan, 0.3]),
        (8, 2, [math.inf, 0.3]), (9, 2, []), (10, 2, [0.3]), (100, 2, [0.3, 0.3, 0.3]), (11, 3, [0.3, 0.2, 0.4]),
        (12, 2, [0.2, 0.2, 0.4]), (200, 5, []), (201, 5, []), (13, 4, []), (300, 1, [-1.0, 0.0]), (14, 1, [0.0, -0.0]),
        (15, 3, [big, 0.0]), (16, 1, [big, big]), (400, 1, [big, 1.0]), (17, 3, [huge, -huge]), (18, 1, [huge, huge]),
        (500, 3, [huge, tiny]), (19, 3, [1e308, 1e308]), (600, 8, [1.0, 1.0]), (20, 3, [big / 2, big / 2]),
    ]
    assert mined(spark, staging, rows) == brute(rows, lambda i: i % 100 == 0)
    assert mined(spark, staging, []) == [] and mined(spark, staging, rows, lambda c: c < 0) == []


def test_a_full_task_does_not_grow_with_its_rows(spark, staging):
    """What a task hands on is bounded by its anchors, slots and ranks."""
    rows = spark.range(20_000).selectExpr(
        "id as vec_id", "cast(id % 2 as int) as label", "array(cast(id % 97 as double), cast(id % 89 as double)) as embedding")
    anchors = hard_negatives._anchor_groups(
        [{"anchor": 0, "id": 0, "label": 0, "vector": [1.0, 1.0]}], {0: [100_000_000, 90_000_000, 80_000_000]})
    plain = rows.select(F.col("vec_id").alias("id"), F.col("label").cast("long").alias("label"), F.col("embedding").alias("vector"))
    found = hard_negatives._searched(plain.repartition(4), anchors, 1000)
    assert found.count() <= 4 * 3 * hard_negatives.NEGATIVES
