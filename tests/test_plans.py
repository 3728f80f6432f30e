"""Physical plans and skew: what must (not) be in a plan, and hot keys at lowered thresholds."""

from __future__ import annotations

import re

import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from clinspark.operators.codes import CodeBranch, build_codes
from clinspark.operators.dedup import first_per_key
from clinspark.operators.relink import delete_orphans, first_encounters, reassign_orphans
from clinspark.operators.visits import visit_cells
from clinspark.queries import QUERIES, encounters, table
from clinspark.staging import Staging


@pytest.fixture
def settings(spark):
    changed = {}

    def set_to(**values):
        for key, value in values.items():
            key = key.replace("__", ".")
            changed.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield set_to
    for key, value in changed.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_trim_reaches_the_scan(spark, sf_dir):
    assert "GreaterThanOrEqual(o_orderdate" in plan(QUERIES["launch_trim"](spark, sf_dir))
    assert "GreaterThanOrEqual(o_orderdate,ScalarSubquery" in plan(QUERIES["history_window"](spark, sf_dir))


def test_only_needed_columns_are_read(spark, sf_dir):
    schemas = re.findall(r"ReadSchema: struct<(.*?)>\n", plan(QUERIES["pk_audit"](spark, sf_dir)))
    assert schemas == ["l_orderkey:bigint,l_linenumber:int"]


def test_duplicates_are_cut_before_the_shuffle(spark, sf_dir):
    text = plan(first_per_key(table(spark, sf_dir, "lineitem"), ["l_orderkey"], ["l_linenumber"]))
    tree = text[: text.index("\n\n(1)")]
    limit, exchange = [m.start() for m in re.finditer("WindowGroupLimit", tree)], tree.index("Exchange")
    assert len(limit) == 2 and limit[0] < exchange < limit[1]


def test_dictionary_reduces_before_the_shuffle(spark, sf_dir):
    branches = [CodeBranch("A", "part", "p_brand", "p_name"), CodeBranch("B", "events", "event_type", "props")]
    codes = build_codes({t: table(spark, sf_dir, t) for t in ("part", "events")}, branches)
    tree = plan(codes)
    tree = tree[: tree.index("\n\n(1)")]
    assert tree.count("Exchange") == 2
    assert re.search(r"HashAggregate.*\n.*Exchange.*\n.*HashAggregate", tree)


def test_first_encounter_is_a_partial_aggregate(spark, sf_dir):
    text = plan(first_encounters(encounters(spark, sf_dir)))
    assert "partial_min_by" in text and "Window" not in text


def test_visit_cells_are_reduced_before_the_window(spark, sf_dir):
    text = plan(visit_cells(encounters(spark, sf_dir), ["patient"], gap_days=30))
    assert "partial_min" in text and text.index("Window") < text.index("HashAggregate")


@pytest.mark.parametrize("name,scanned", [
    ("delete_orphans", "lineitem"), ("orphans", "lineitem"), ("visit_assign", "lineitem")])
def test_one_wide_scan(spark, sf_dir, name, scanned):
    text = plan(QUERIES[name](spark, sf_dir))
    scans = [part for part in text.split("Location: ")[1:] if f"{scanned}.parquet" in part.split("\n")[0]]
    assert len(scans) == 1


def test_first_value_reads_for_the_aggregate_and_the_rows(spark, sf_dir):
    text = plan(QUERIES["first_value_window"](spark, sf_dir))
    assert text.count("Location: ") == 2 and "Window" not in text


def hot_child(spark, staging):
    """A third of the rows share one encounter, a third have none."""
    df = spark.range(120_000).select(
        F.col("id").alias("n"),
        F.when(F.col("id") % 3 == 0, F.lit(-1)).when(F.col("id") % 3 == 1, None).otherwise(F.col("id") % 5000).alias("encounter"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 100).alias("patient"),
        F.md5(F.col("id").cast("string")).alias("text"),
    )
    return staging.table(df.repartition(8))


def test_hot_keys_are_split(spark, staging, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
             spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="64KB",
             spark__sql__adaptive__skewJoin__skewedPartitionFactor="2.0",
             spark__sql__adaptive__advisoryPartitionSizeInBytes="64KB")
    child = hot_child(spark, staging)
    parents = staging.table(spark.range(2000).selectExpr("id", "id % 100 as patient", "timestamp_ntz'2010-01-01' as start"))
    out = reassign_orphans(child, parents, first_encounters(parents), stage=staging)
    assert out.count() == 120_000
    got = out.agg(F.count_if(F.col("encounter").isNull()), F.count_if((F.col("patient") == 7) & (F.col("encounter") == 7))).first()
    assert got[0] == 40_000 and got[1] >= 40_000
    out.collect()
    assert "skew=true" in out._jdf.queryExecution().toString()
    kept = delete_orphans(child, parents)
    kept.collect()
    assert kept.where("encounter is null").count() == 40_000
    assert kept.where("encounter = -1").count() == 0
    assert kept.where("encounter is not null").count() == child.where("encounter between 0 and 1999").count()
    assert "skew=true" in kept._jdf.queryExecution().toString()


def test_hot_duplicates(spark, staging):
    df = staging.table(spark.range(90_000).selectExpr("if(id % 3 = 0, 0, id) as k", "id as n"))
    assert rows(first_per_key(df, ["k"], ["n"]).where("k = 0")) == [(0, 0)]


def test_duplicates_move_narrow_rows_only(spark, tmp_path):
    from clinspark.operators.dedup import dedup_table

    df = spark.range(2000).selectExpr("id % 1990 as id", "id as place", "repeat('wide ', 50) as text")
    df.write.parquet(str(tmp_path / "t"))
    stored = Staging(spark)
    out = dedup_table(spark.read.parquet(str(tmp_path / "t")), ["place"], stored)
    assert rows(out.selectExpr("count(*)", "count(distinct id)")) == [(1990, 1990)]
    text = plan(out)
    assert "Exchange\n" not in text.replace("BroadcastExchange", "") and "BroadcastHashJoin" in text and "Sort" not in text


def test_hot_duplicates_of_a_table(spark, staging):
    from clinspark.operators.dedup import dedup_table

    df = staging.table(spark.range(60_000).selectExpr(
        "if(id % 3 = 0, null, id % 1000) as id", "id as n", "id % 7 as part", "id as place"))
    got = dedup_table(df, ["part", "place"], staging)
    want = {}
    for r in df.collect():
        key = (r["part"], r["place"])
        if r["id"] not in want or key < want[r["id"]][0]:
            want[r["id"]] = (key, r["n"])
    assert {r["id"]: r["n"] for r in got.collect()} == {k: n for k, (_, n) in want.items()} and got.count() == len(want)


def test_references_read_each_table_once(spark, sf_dir):
    text = plan(QUERIES["fk_audit"](spark, sf_dir))
    for name, scans in {"lineitem": 1, "customer": 1, "nation": 1, "part": 1, "supplier": 1, "orders": 2}.items():
        # Orders are read once more, as the trimmed encounters.
        assert text.count(f"/{name}.parquet]") == scans, name
    assert "partial_count" in text
