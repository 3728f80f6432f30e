"""No task is given rows or values that could as well be dealt to many."""

from __future__ import annotations

import pytest
from helpers import rows
from pyspark.sql import functions as F

from clinspark.operators.relink import delete_orphans


@pytest.fixture
def plain(spark):
    """Neither splits of skewed partitions nor broadcasts."""
    changed = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_null_keys_are_dealt(spark, plain):
    child = spark.range(30_000).select("id", F.when(F.col("id") % 2 == 0, F.col("id") % 100).alias("encounter"))
    kept = delete_orphans(child, spark.range(50))
    parts = kept.where("encounter is null").groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in parts) == 15_000 and max(r["count"] for r in parts) < 7_500
    assert kept.where("encounter is not null").count() == child.where("encounter < 50").count()


def test_null_keys_beside_odd_columns(spark):
    child = spark.sql("select * from values (1, map(1, 2), array(1)), (null, map(1, 2), null), (9, null, null) as t(encounter, m, a)")
    parents = spark.sql("select * from values (1), (1), (null) as t(id)")
    assert rows(delete_orphans(child, parents), "encounter") == [(None,), (1,)]
    assert rows(delete_orphans(child.select("encounter"), parents)) == [(None,), (1,)]
    assert rows(delete_orphans(child, parents, keep_null=False), "encounter") == [(1,)]
